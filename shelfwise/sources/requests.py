"""Request files in, answer files out."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise.schemas import REQUESTS


def read_requests(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """JSON lines with the one field of a ``product``, ``user`` or ``text`` request."""
    return spark.read.schema(REQUESTS[kind]).json(path)


def nest_answers(requests: DataFrame, rows: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """One row per request key with its ranked items; an empty list where nothing was found.

    Repeated requests have repeated rows; these are dropped before a list is gathered.
    """
    item = F.struct("rank", *fields)
    lists = rows.select(key, "rank", *fields).distinct().groupBy(key).agg(F.array_sort(F.collect_list(item)).alias("items"))
    bare = F.transform(
        F.coalesce("items", F.array().cast(lists.schema["items"].dataType)),
        lambda x: F.struct(*[x[f].alias(f) for f in fields]),
    )
    keys = requests.select(key).distinct()
    return keys.join(lists, key, "left").select(key, bare.alias("items"))


def write_answers(answers: DataFrame, path: str) -> None:
    """JSON lines with null fields written out."""
    answers.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
