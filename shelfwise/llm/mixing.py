"""Mixing sources to target weights by systematic sampling."""

import random

from pyspark.sql import DataFrame, functions as F

from shelfwise.llm.ordered import running_sums

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
SEED = 20240229

WORD = r"[^\x20\x09-\x0D]+"


def offset(seed: int = SEED) -> float:
    """The one random offset of a mix, from zero to below one."""
    return random.Random(seed).random()


def word_count(text: str):
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """Per source its whole size, its target and the expected copies of each of its documents.

    ``sizes`` has no_source, source_name and source_size, one row per source. Weights are dealt in
    order of the names, those without a name last. Targets share ``SHARE`` of all sizes by weight,
    no target goes beyond ``MOST`` times its source's size, and what that frees is shared again: in
    order of limit to weight, the sources that stay below their share are a prefix.
    """
    ranked = running_sums(sizes, [], ["no_source", "source_name"], {"rank": F.lit(1)})
    place = F.pmod(F.col("rank") - 1, F.lit(len(WEIGHTS))) + 1
    weighed = ranked.select(
        "no_source", "source_name", "source_size",
        F.element_at(F.array(*map(F.lit, WEIGHTS)), place.cast("int")).cast("long").alias("weight"),
        (F.col("source_size") * MOST).alias("limit"),
    ).withColumn("fill", F.col("limit") / F.col("weight"))
    swept = running_sums(
        weighed, [], ["fill", "no_source", "source_name"],
        {"limits": F.col("limit"), "weights": F.col("weight")},
    )
    total, weights = swept.agg(F.sum("source_size"), F.sum("weight")).first()
    wanted = SHARE * (total or 0)
    left = F.lit(wanted) - (F.col("limits") - F.col("limit")).cast("double")
    open_weights = (F.lit(weights or 0) - F.col("weights") + F.col("weight")).cast("double")
    swept = swept.withColumn("full", F.col("limit") * open_weights <= left * F.col("weight"))
    taken, full_weights = swept.where("full").agg(F.sum("limit"), F.sum("weight")).first()
    rest = (weights or 0) - (full_weights or 0)
    level = (wanted - (taken or 0)) / rest if rest else 0.0
    target = F.when(F.col("full"), F.col("limit").cast("double")).otherwise(F.col("weight") * F.lit(level))
    return swept.select(
        "no_source", "source_name", F.col("source_size").alias("whole_size"), target.alias("target"),
        F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0).alias("rate"),
    )


def mix(docs: DataFrame, seed: int = SEED, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``size`` (words of the text), ``source_size``, ``target`` and ``copies``.

    Within a source, in order of size and then ``doc_id``, each document expects the same number of
    copies, target by source size. Their running sum plus one random offset is taken, and a
    document gets a copy for each integer it crosses. Ordering by size keeps the words taken within
    about one document of the target.

    Null text: size 0. Null source: a source of its own, last. Null ``doc_id``: before the others
    of its size. Repeated rows: each is counted and gets its own copies. A source without words
    gets no copies. Columns of the input named like an added one are replaced. An empty table gives
    an empty table. Reruns give the same copies.
    """
    added = ["size", "source_size", "target", "copies"]
    given = [c for c in keep or docs.columns if c not in added]
    sized = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in given]).alias("row"),
        F.col("source").isNull().alias("no_source"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source_name"),
        F.col("doc_id").cast("long").alias("id"),
        word_count("text").alias("size"),
    )
    placed = running_sums(
        sized, ["no_source", "source_name"], ["size", "id"], {"nth": F.lit(1), "source_size": F.col("size")},
        attach=source_targets,
    )
    u = offset(seed)
    copies = F.floor(F.col("nth") * F.col("rate") + u) - F.floor((F.col("nth") - 1) * F.col("rate") + u)
    return placed.select(
        *[F.col("row").getField(c).alias(c) for c in given],
        "size", F.col("whole_size").alias("source_size"), "target", F.least(copies, F.lit(MOST)).cast("long").alias("copies"),
    )


def emit(mixed: DataFrame) -> DataFrame:
    """One row per copy, numbered from 1 in column copy."""
    repeated = mixed.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return repeated.drop("size", "source_size", "target", "copies")
