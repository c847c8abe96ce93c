"""Stored recommendation lists: packing, lookup, blending."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise.session import parallelism, staged
from shelfwise.sources.tables import of_keys

# Length of a stored list, of an answer, and the share of the collaborative score.
STORED_ITEMS = 100
ANSWER_ITEMS = 10
CF_WEIGHT = 0.8


def pack(pairs: DataFrame) -> DataFrame:
    """``id, pid, r`` rows, already cut to k per id, to one ordered list per id."""
    best_first = F.sort_array(F.collect_list(F.struct((-F.col("r")).alias("n"), "pid", "r")))
    return pairs.groupBy("id").agg(
        F.transform(best_first, lambda x: F.struct(x.pid.alias("pid"), x.r.alias("r"))).alias("recs")
    )


def best_of(recs: Column, n: int) -> Column:
    """The n best entries of a stored list, by score descending and then product id.

    A missing product id or score counts as 0.
    """
    keyed = F.transform(
        recs,
        lambda x: F.struct(
            (-F.coalesce(x.r, F.lit(0.0))).alias("n"),
            F.coalesce(x.pid, F.lit(0)).alias("pid"),
            F.coalesce(x.r, F.lit(0.0)).alias("r"),
        ),
    )
    return F.slice(F.sort_array(keyed), 1, n)


def lookup(requests: DataFrame, stored: DataFrame, key: str, n: int = ANSWER_ITEMS) -> DataFrame:
    """Ranked items of each requested id: ``key, rank, productId, rating``; none for unknown ids.

    The list is cut before the join, so only n items per id travel. Of a table stored by id, only the
    folders of the requested ids are read. Each id is looked up once, however often it is asked.
    """
    ids = requests.select(key).distinct()
    short = of_keys(stored, ids).select(F.col("id").alias(key), best_of(F.col("recs"), n).alias("items"))
    answers = (
        ids.join(short, key)
        .select(key, F.posexplode("items").alias("pos", "x"))
        .select(
            key,
            (F.col("pos") + 1).alias("rank"),
            F.col("x.pid").alias("productId"),
            F.col("x.r").alias("rating"),
        )
    )
    return for_each_request(requests, answers, key)


#: Equal requests that one row stands for until its answers are written out.
TIMES_PER_ROW = 10_000


def for_each_request(requests: DataFrame, answers: DataFrame, *key: str) -> DataFrame:
    """The answers to every request, ``requests`` and ``answers`` joined on the columns ``key``.

    ``answers`` holds a bounded list for each key. Equal requests are counted before they travel. A key
    that more requests ask for than a task's share is spread over as many salts, and its answers go to
    each of them; there are at most as many such keys as the session's shuffle width, so their table
    may be broadcast. Requests whose key is null or unknown have no rows; a request asked several times
    has its rows each time.
    """
    key, columns = list(key), requests.columns
    width = parallelism(requests.sparkSession)
    asked = requests.dropna(subset=key).groupBy(*columns).agg(F.count("*").alias("_times"))
    asked = asked.withColumn("_piece", F.explode(F.expr(f"sequence(0L, (_times - 1) div {TIMES_PER_ROW})")))
    asked = asked.withColumn("_times", F.least(F.lit(TIMES_PER_ROW), F.col("_times") - F.col("_piece") * TIMES_PER_ROW))
    asked = staged(asked, "asked")
    per_key = asked.groupBy(*key).agg(F.sum("_times").alias("_n"))
    total = asked.agg(F.sum("_times")).first()[0] or 0
    hot = per_key.where(F.col("_n") * width > total).select(
        *key, F.ceil(F.col("_n") * width / F.lit(max(total, 1))).cast("int").alias("_salts")
    )
    hot = F.broadcast(hot)
    salts = F.coalesce("_salts", F.lit(1))
    spread = asked.join(hot, key, "left").withColumn("_salt", F.pmod(F.xxhash64(*columns, "_piece"), salts))
    copies = answers.join(hot, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), salts.cast("long") - 1)))
    joined = spread.drop("_salts").join(copies.drop("_salts"), [*key, "_salt"])
    added = [c for c in answers.columns if c not in key]
    every = joined.withColumn("_time", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times"))))
    return every.select(*columns, *added)


def blend(
    collaborative: DataFrame, content: DataFrame, key: str, cf_weight: float = CF_WEIGHT
) -> DataFrame:
    """Both ranked lists side by side with weighted scores; a product may occur twice."""

    def weighted(rows, source, weight):
        return rows.select(
            key,
            F.lit(source).alias("source"),
            F.col("rank").alias("sourceRank"),
            "productId",
            F.col("rating").alias("originalRating"),
            (F.col("rating") * weight).alias("hybridRating"),
        )

    return weighted(collaborative, 0, cf_weight).unionByName(weighted(content, 1, 1 - cf_weight))


def best_blended(blended: DataFrame, key: str, n: int = ANSWER_ITEMS) -> DataFrame:
    """The n best of a blend; on ties collaborative rows come first, then the source's order."""
    order = Window.partitionBy(key).orderBy(F.desc("hybridRating"), "source", "sourceRank")
    return (
        blended.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= n)
        .select(key, "rank", "productId", "originalRating", "hybridRating")
    )
