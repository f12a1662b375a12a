"""The queries of this subpackage by name, and the SQL for those that DuckDB can run over whole tables."""

from __future__ import annotations

from brooklog.llm.decontaminate import op7_decontaminate
from brooklog.llm.exact_dedup import OP1_SQL, op1_exact_dedup
from brooklog.llm.language_id import op2_language_id
from brooklog.llm.line_dedup import OP9_SQL, op9_line_dedup
from brooklog.llm.ngram_join import op4_ngram_join
from brooklog.llm.packing import op5_packing
from brooklog.llm.pii import op8_pii
from brooklog.llm.secrets_scan import op3_secret_scan
from brooklog.llm.substring_dedup import OP6_SQL, op6_substring_dedup
from brooklog.llm.warc import OP10_SQL, op10_warc

QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_language_id": op2_language_id,
    "op3_secret_scan": op3_secret_scan,
    "op4_ngram_join": op4_ngram_join,
    "op5_packing": op5_packing,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_decontaminate": op7_decontaminate,
    "op8_pii": op8_pii,
    "op9_line_dedup": op9_line_dedup,
    "op10_warc": op10_warc,
}
ORACLE_SQL = {
    "op1_exact_dedup": OP1_SQL,
    "op6_substring_dedup": OP6_SQL,
    "op9_line_dedup": OP9_SQL,
    "op10_warc": OP10_SQL,
}
