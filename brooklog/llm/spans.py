"""Places of regular-expression matches, from column functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPANS = "array<struct<start:int,end:int,value:string>>"


def none() -> Column:
    return F.array().cast(SPANS)


def matches(text: Column, pattern: str, gate: Column | None = None) -> Column:
    """All matches, leftmost first, without overlap; gate: a cheap test that is false only where there are none."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return found if gate is None else F.when(gate, found).otherwise(F.array().cast("array<string>"))


#: Matches of a block: their lengths are added up by block first. (An aggregate copies what it has gathered at each step, so it can't gather places.)
BLOCK = 64


def with_spans(df: DataFrame, patterns: dict[str, str], gates: dict[str, Column | None] | None = None, text: str = "text") -> DataFrame:
    """df with a column for each pattern: start, end (code points, end exclusive) and value of its matches. Matches and the gaps between them follow one another, so places are sums of lengths.

    What a lambda looks at is a column that is used twice at least, so that it is not worked out again at each step."""
    keep, total = df.columns, lambda a: F.aggregate(a, F.lit(0), lambda x, y: x + y)
    df = df.select("*", *(matches(F.col(text), p, (gates or {}).get(k)).alias(f"{k}__found") for k, p in patterns.items()))
    # of each match: the gap before it and itself
    lengths = lambda k, p: F.zip_with(F.split(F.col(text), p, -1), F.col(f"{k}__found"), lambda g, f: F.length(g) + F.coalesce(F.length(f), F.lit(0)))
    df = df.select("*", *(F.when(F.size(f"{k}__found") > 0, lengths(k, p)).alias(f"{k}__lengths") for k, p in patterns.items()))
    numbers = lambda n: F.sequence(F.lit(0), n - 1)
    of_blocks = lambda k: F.transform(numbers(F.ceil(F.size(f"{k}__lengths") / BLOCK).cast("int")), lambda b: total(F.slice(f"{k}__lengths", b * BLOCK + 1, F.lit(BLOCK))))
    df = df.select("*", *(F.when(F.col(f"{k}__lengths").isNotNull(), of_blocks(k)).alias(f"{k}__blocks") for k in patterns))
    before = lambda k: F.transform(numbers(F.size(f"{k}__blocks")), lambda b: total(F.slice(f"{k}__blocks", F.lit(1), b)))
    df = df.select("*", *(F.when(F.col(f"{k}__blocks").isNotNull(), before(k)).alias(f"{k}__before") for k in patterns))

    def places(k: str) -> Column:
        def one(value: Column, i: Column) -> Column:
            block = F.floor(i / BLOCK).cast("int")
            end = F.col(f"{k}__before")[block] + total(F.slice(f"{k}__lengths", block * BLOCK + 1, i - block * BLOCK + 1))
            return F.struct((end - F.length(value)).alias("start"), end.alias("end"), value.alias("value"))

        return F.when(F.col(f"{k}__before").isNotNull(), F.transform(f"{k}__found", one)).otherwise(none())

    return df.select(*keep, *(places(k).alias(k) for k in patterns))


def of_kind(found: Column, kind: int) -> Column:
    """For sorting by start, then kind."""
    return F.transform(found, lambda x: F.struct(x["start"].alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end")))


def joined(found: Column, kinds: list[str]) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, kinds))
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", names[x["kind"]], x["start"].cast("string"), x["end"].cast("string"))), ",")


def overlaps(x: Column, others: str) -> Column:
    """Whether x overlaps one of the column others, which are in order and apart: the first that ends after x starts, by halving, is the only one that need be looked at."""

    def step(acc: Column, _: Column) -> Column:
        middle = F.floor((acc["low"] + acc["high"]) / 2).cast("int")
        after, done = F.get(others, middle)["end"] > x["start"], acc["low"] >= acc["high"]
        return F.struct(F.when(done | after, acc["low"]).otherwise(middle + 1).alias("low"), F.when(~done & after, middle).otherwise(acc["high"]).alias("high"))

    halvings = F.sequence(F.lit(0), F.floor(F.log2(F.greatest(F.size(others), F.lit(1)).cast("double"))).cast("int") + 1)
    first = F.aggregate(halvings, F.struct(F.lit(0).alias("low"), F.size(others).alias("high")), step, lambda acc: acc["low"])
    return (F.size(others) > 0) & F.coalesce(F.get(others, first)["start"] < x["end"], F.lit(False))
