"""Secret scanning from column functions alone.

Three kinds of secrets are known by their form (assignments of named secrets, access key ids, long hexadecimal strings). Beyond them,
candidate strings (20 or more letters, digits and signs, with a letter and a digit) are judged by the Shannon entropy of a window that
slides over them: the counts of the window's characters and the sum of c * log2(c) change by one character in and one out. A candidate
counts as a secret if some window reaches its character class's threshold, unless the allow-list suppresses it or it overlaps a span
known by form.

Defined results: a null text counts as empty; every row gets a row, also one that repeats another or has a null id; an empty table gives
no rows; other columns are ignored whatever their names. Work grows with a text's length and the number of its matches.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklog.llm.common import text_of
from brooklog.llm.spans import joined, none, of_kind, overlaps, with_spans

ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Runs of these characters match as wholes, so a least length can stand in the pattern.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
SIGNS = "A-Za-z0-9+/_=-"
CANDIDATE = rf"(?<![{SIGNS}])(?=[{SIGNS}]*?[0-9])(?=[{SIGNS}]*?[A-Za-z])[{SIGNS}]{{20,}}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
WINDOW = 20
#: Least entropy of a window in bits, by class; the first class whose pattern the whole candidate matches.
CLASSES = [("^[0-9a-fA-F]+$", 3.0), ("^[A-Za-z0-9+/=]+$", 3.6), (f"^[{SIGNS}]+$", 3.7)]
#: Candidates that hold one of these are suppressed.
ALLOW = ["(?i)example|sample|placeholder|changeme|dummy", "(?i)(.)\\1{5}", "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$", "(?i)0123456789|abcdefgh"]
KINDS = ["assign", "access", "hex", "entropy"]


#: Counters of the alphabet's characters in a number, and bits of a counter.
PACKED, BITS = 10, 6


def peak_entropy(value: Column, window: int = WINDOW) -> Column:
    """The largest Shannon entropy, in bits, of any window of value: a character that comes and one that goes change two counters, which are packed into a few numbers, and the sum of c * log2(c)."""
    if not 0 < window < 1 << BITS:
        raise ValueError(f"a window has 1 to {(1 << BITS) - 1} characters")
    n = -(-len(ALPHABET) // PACKED)
    terms = F.array(*(F.lit(c * math.log2(c) if c else 0.0) for c in range(window + 2)))

    def step(codes: Column, acc: Column, i: Column) -> Column:
        # in three steps, each of which names what the next uses
        coming, going = F.get(codes, i), F.when(i >= window, F.get(codes, F.greatest(i - window, F.lit(0)))).otherwise(-1)
        one = F.array(F.struct(coming.alias("coming"), going.alias("going")))

        def counted(x: Column) -> Column:
            count = lambda code: F.call_function("shiftright", acc["counts"][F.greatest((code / PACKED).cast("int"), F.lit(0))], BITS * F.pmod(code, F.lit(PACKED))).bitwiseAND(F.lit((1 << BITS) - 1)).cast("int")
            return F.struct(x["coming"].alias("coming"), x["going"].alias("going"), count(x["coming"]).alias("more"), count(x["going"]).alias("fewer"))

        def changed(x: Column) -> Column:
            same = x["coming"] == x["going"]
            total = acc["total"] + F.when(same, 0.0).otherwise(terms[x["more"] + 1] - terms[x["more"]] + F.when(x["going"] >= 0, terms[F.greatest(x["fewer"] - 1, F.lit(0))] - terms[x["fewer"]]).otherwise(0.0))
            unit = lambda code, k: F.when((code >= 0) & ((code / PACKED).cast("int") == k), F.call_function("shiftleft", F.lit(1).cast("long"), BITS * F.pmod(code, F.lit(PACKED)))).otherwise(F.lit(0).cast("long"))
            counts = F.transform(acc["counts"], lambda c, k: c + unit(x["coming"], k) - unit(x["going"], k))
            return F.struct(counts.alias("counts"), total.alias("total"))

        def judged(x: Column) -> Column:
            best = F.when(i >= window - 1, F.greatest(acc["best"], F.lit(math.log2(window)) - x["total"] / window)).otherwise(acc["best"])
            return F.struct(x["counts"].alias("counts"), x["total"].alias("total"), best.alias("best"))

        return F.transform(F.transform(F.transform(one, counted), changed), judged)[0]

    begin = F.struct(F.array_repeat(F.lit(0).cast("long"), n).alias("counts"), F.lit(0.0).alias("total"), F.lit(0.0).alias("best"))
    codes = F.transform(F.filter(F.split(value, ""), lambda c: c != ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    # an array of one, so that the codes are worked out once
    return F.transform(F.array(codes), lambda own: F.aggregate(F.sequence(F.lit(0), F.size(own) - 1), begin, lambda acc, i: step(own, acc, i), lambda acc: acc["best"]))[0]


def is_secret(value: Column, window: int = WINDOW, classes=CLASSES, allow=ALLOW) -> Column:
    least = F.lit(None).cast("double")
    for pattern, bits in reversed(classes):
        least = F.when(value.rlike(pattern), F.lit(bits)).otherwise(least)
    allowed = F.lit(False)
    for pattern in allow:
        allowed = allowed | value.rlike(pattern)
    return ~allowed & F.coalesce(peak_entropy(value, window) >= least, F.lit(False))


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW, classes=CLASSES, allow=ALLOW) -> DataFrame:
    """id, and base and added: spans (start, kind: an index of KINDS, end) in order."""
    df = docs.select(docs[id_column].alias("id"), text_of(docs, text_column).alias("text"))
    patterns = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "candidate": CANDIDATE}
    gates = {"assign": None, "access": F.contains("text", F.lit("AKIA")), "hex": None, "candidate": None}
    df = with_spans(df, patterns, gates).drop("text")
    df = df.withColumn("assign", F.filter("assign", lambda x: F.length(F.regexp_extract(x["value"], f"^{ASSIGN}", 2)) >= 6))
    df = df.withColumn("base", F.sort_array(F.concat(*(of_kind(F.col(k), n) for n, k in enumerate(KINDS[:3])))))
    apart = lambda x: ~overlaps(x, "assign") & ~overlaps(x, "access") & ~overlaps(x, "hex")
    extra = F.filter("candidate", lambda x: apart(x) & is_secret(x["value"], window, classes, allow))
    df = df.withColumn("added", F.when(F.size("candidate") > 0, extra).otherwise(none()))
    return df.select("id", "base", of_kind(F.col("added"), 3).alias("added"))


def count(kind: int, found: str = "base") -> Column:
    return F.size(F.filter(found, lambda x: x["kind"] == kind)).cast("long")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    base = joined(F.col("base"), KINDS)
    return found.select(
        F.col("id").alias("doc_id"), *(count(n).alias(f"n_{k}") for n, k in enumerate(KINDS[:3])), F.sha2(base.cast("binary"), 256).alias("base_sha256"),
        joined(F.sort_array(F.concat("base", "added")), KINDS).alias("spans"), count(3, "added").alias("n_entropy"),
    )
