"""Personal data by bootstrapped contextual extraction, from column functions alone.

Seeds are entities known by their form (e-mail and IP addresses, card and phone numbers). Every seed, and every other string with a
digit, is an instance (strings without a digit are none); the two words before it, the two after it, and of each side the nearer one
alone, are lexical patterns. Patterns and instances form a bipartite graph, scored in rounds: a pattern's score is the mean score of its
different instances, an instance that is no seed gets the chance that any of its two-word patterns is right (1 minus the product of 1
minus their scores; the nearer word alone is part of those, not further evidence). In that chance the instance itself counts as 0 in its
patterns' means, so it gets no evidence from its own score, least of all by a pattern that it has alone. Patterns of high score, with enough different seeds,
then discover identifiers of unknown form, which are added as spans of kind `context`.

Per document only its spans and instances are written, not its text. All patterns take part in the rounds, however few instances they
have; only those that are accepted need the support. Pairs are counted before they are joined, so common patterns cost a row for each
different instance.

Defined results: a null text counts as empty; every row gets a row, also one that repeats another or has a null id; an empty table gives
no rows; other columns are ignored whatever their names.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklog.llm.common import shared_dir, text_of, written
from brooklog.llm.secrets_scan import count
from brooklog.llm.spans import joined, none, of_kind, overlaps, with_spans

LOCAL = "A-Za-z0-9._%+-"
#: As in the contract, with possessive quantifiers (nothing that follows could take a character back) and without new starts inside a run, where a match can only fail again; so long runs cost linear time and no recursion. After a match the rest of its run is tried (\G).
EMAIL = rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
OTHER = r"(?<![A-Za-z0-9._@+-])(?=[A-Za-z._@+-]*+[0-9])[A-Za-z0-9@+][A-Za-z0-9._@+-]{4,}"
KINDS = ["email", "ip", "card", "phone", "context"]
ROUNDS, MIN_SEEDS, MIN_SCORE = 3, 3, 0.8
#: Code points of a block of text. An instance's two words are sought in its block and the next one, so of longer words the nearer part of one block or more counts.
BLOCK = 4096
#: First characters of patterns: side, words.
BEFORE, BEFORE_ONE, AFTER, AFTER_ONE = "<2 ", "<1 ", ">2 ", ">1 "


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether the last digit is right: every second digit from the right counts double, less 9 if above 9."""
    value = lambda i: F.ascii(F.substring(F.reverse(number), i, F.lit(1))) - 48
    one = lambda i: F.when(i % 2 == 1, value(i)).otherwise(value(i) * 2 - F.when(value(i) > 4, 9).otherwise(0))
    return F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), lambda acc, i: acc + one(i)) % 10 == 0


def small_parts(value: Column) -> Column:
    """All parts at most 255, leading zeros aside."""
    part = lambda x: F.regexp_replace(x, "^0+(?=[0-9])", "")
    return F.forall(F.split(value, r"\."), lambda x: (F.length(part(x)) <= 3) & (F.lpad(F.right(part(x), F.lit(3)), 3, "0") <= "255"))


def valid(kind: str, x: Column) -> Column:
    if kind == "card":
        return F.length(digits(x["value"])).between(12, 19) & luhn(F.left(digits(x["value"]), F.lit(19)))
    if kind == "phone":
        return F.length(digits(x["value"])).between(9, 15)
    return small_parts(x["value"]) if kind == "ip" else F.lit(True)


def instances(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, text_key, base (spans by KINDS), occurrences (start, end, value, patterns, seed)."""
    df = docs.select(docs[id_column].alias("id"), text_of(docs, text_column).alias("text"))
    df = df.withColumn("digit", F.col("text").rlike("[0-9]"))
    patterns = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE, "other": OTHER}
    gates = {"email": F.contains("text", F.lit("@")), "phone": F.contains("text", F.lit("+")) & F.col("digit")}
    df = with_spans(df, patterns, {k: gates.get(k, F.col("digit")) for k in patterns})
    df = df.select("id", "text", "other", *(F.when(F.size(k) > 0, F.filter(k, partial(valid, k))).otherwise(none()).alias(k) for k in KINDS[:4]))
    df = df.withColumn("seeds", F.concat(*KINDS[:4]))
    apart = lambda x: ~overlaps(x, "email") & ~overlaps(x, "ip") & ~overlaps(x, "card") & ~overlaps(x, "phone")
    df = df.withColumn("other", F.when(F.size("other") > 0, F.filter("other", apart)).otherwise(none()))
    # the text in blocks, so that what stands around an instance is found without a look at all that comes before it
    df = df.withColumn("blocks", F.when(F.size("seeds") + F.size("other") > 0, F.regexp_extract_all("text", F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))))

    def occurrence(x: Column, seed: bool) -> Column:
        block = lambda place, k: F.coalesce(F.get("blocks", F.floor(place / BLOCK).cast("int") + k), F.lit(""))
        before = F.lower(F.concat(block(x["start"], -1), F.substring(block(x["start"], 0), F.lit(1), F.pmod(x["start"], F.lit(BLOCK)))))
        after = F.lower(F.concat(F.substring(block(x["end"], 0), F.pmod(x["end"], F.lit(BLOCK)) + 1, F.lit(BLOCK)), block(x["end"], 1)))
        # possessive, and from the starts of words only, so that a try never takes back what it took
        sides = [(BEFORE, before, r"(?<!\S)((?:\S++\s++)?+\S++)\s*+$"), (BEFORE_ONE, before, r"(?<!\S)(\S++)\s*+$"), (AFTER, after, r"^\s*(\S+(?:\s+\S+)?)"), (AFTER_ONE, after, r"^\s*(\S+)")]
        patterns = F.filter(F.array(*(F.concat(F.lit(k), F.regexp_extract(t, p, 1)) for k, t, p in sides)), lambda p: F.length(p) > len(BEFORE))
        return F.struct(x["start"].alias("start"), x["end"].alias("end"), F.lower(x["value"]).alias("value"), patterns.alias("patterns"), F.lit(seed).alias("seed"))

    found = F.concat(F.transform("seeds", lambda x: occurrence(x, True)), F.transform("other", lambda x: occurrence(x, False)))
    base = F.sort_array(F.concat(*(of_kind(F.col(k), n) for n, k in enumerate(KINDS[:4]))))
    return df.select("id", F.xxhash64("text").alias("text_key"), base.alias("base"), found.alias("occurrences"))


def confident_patterns(table: DataFrame, scratch: str, rounds: int = ROUNDS, min_seeds: int = MIN_SEEDS, min_score: float = MIN_SCORE) -> DataFrame:
    """pattern, score: from the graph of patterns and instances."""
    found = table.select(F.explode("occurrences").alias("x")).select(F.explode("x.patterns").alias("pattern"), "x.value", "x.seed")
    edges = written(found.groupBy("pattern", "value").agg(F.max("seed").alias("seed")), f"{scratch}/edges")
    known = edges.groupBy("value").agg(F.max("seed").alias("seed"))
    seeds = written(known.select("value", "seed", F.col("seed").cast("double").alias("score")), f"{scratch}/scores0")
    edges, lifting, scores = edges.select("pattern", "value"), F.substring("pattern", 1, len(BEFORE)).isin(BEFORE, AFTER), seeds
    for k in range(1, rounds + 1):
        graph = edges.join(scores, "value")
        patterns = written(graph.groupBy("pattern").agg(F.avg("score").alias("score"), F.count(F.lit(1)).alias("n"), F.sum(F.col("seed").cast("long")).alias("seeds")), f"{scratch}/patterns{k}")
        if k == rounds:
            break
        evidence = F.col("of_pattern") - F.col("score") / F.col("n")
        miss = graph.where(lifting & ~F.col("seed")).join(patterns.select("pattern", F.col("score").alias("of_pattern"), "n"), "pattern").groupBy("value").agg(F.sum(F.log(F.greatest(1 - evidence, F.lit(1e-9)))).alias("miss"))
        lifted = F.when(F.col("seed"), 1.0).otherwise(1 - F.exp(F.coalesce("miss", F.lit(0.0))))
        scores = written(seeds.drop("score").join(miss, "value", "left").select("value", "seed", lifted.alias("score")), f"{scratch}/scores{k}")
    return patterns.where((F.col("score") >= min_score) & (F.col("seeds") >= min_seeds)).select("pattern", "score")


def extract(docs: DataFrame, scratch: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, base and added: spans (start, kind: an index of KINDS, end) in order."""
    table = written(instances(docs, id_column, text_column), f"{scratch}/instances")
    patterns = confident_patterns(table, scratch)
    others = table.select("id", "text_key", F.explode(F.filter("occurrences", lambda x: ~x["seed"])).alias("x")).select("id", "text_key", "x.start", "x.end", F.explode("x.patterns").alias("pattern"))
    kind = F.struct("start", F.lit(4).alias("kind"), "end")
    found = others.join(patterns, "pattern").groupBy("id", "text_key").agg(F.sort_array(F.collect_set(kind)).alias("found"))
    rows = table.select("id", "text_key", "base").join(found.withColumnsRenamed({"id": "found_id", "text_key": "found_key"}), F.col("id").eqNullSafe(F.col("found_id")) & (F.col("text_key") == F.col("found_key")), "left")
    return rows.select("id", "base", F.coalesce("found", F.array().cast("array<struct<start:int,kind:int,end:int>>")).alias("added"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract(spark.read.parquet(f"{sf_dir}/documents.parquet"), shared_dir(spark, "op8"))
    base = joined(F.col("base"), KINDS)
    return found.select(
        F.col("id").alias("doc_id"), *(count(n).alias(f"n_{k}") for n, k in enumerate(KINDS[:4])), F.sha2(base.cast("binary"), 256).alias("base_sha256"),
        joined(F.sort_array(F.concat("base", "added")), KINDS).alias("spans"), count(4, "added").alias("n_context"),
    )
