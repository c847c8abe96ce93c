"""Serving: request files that keep arriving, answered once each, in files."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise.schemas import REQUESTS
from shelfwise.session import scratch, staged

FILES_PER_BATCH = 1000


def answer_files(
    spark: SparkSession, kind: str, requests: str, answers: str, checkpoint: str,
    answer: Callable[[DataFrame], DataFrame], answered: str, fields: list[str],
    files_per_batch: int = FILES_PER_BATCH,
) -> int:
    """Answer the request files that have come in since the last call, and return how many requests
    they held.

    ``requests`` is a folder of JSON files with ``kind`` requests, ``answer`` turns distinct requests
    into ranked rows under the column ``answered``, as the functions of ``plans.recommend`` do, and
    ``fields`` are kept of each row. The files are a stream; which of them are done stands in
    ``checkpoint``, a folder that outlives the job. A batch of files writes ``batch=<number>`` under
    ``answers``, one line for each request with its file, its key and the ranked items (none where
    nothing was found). A batch that was cut off is run again under its number and replaces what it
    left, so that each file is answered once.
    """
    (key,) = REQUESTS[kind].names
    stream = (
        spark.readStream.schema(REQUESTS[kind]).option("maxFilesPerTrigger", files_per_batch).json(requests)
        .select(F.col("_metadata.file_name").alias("file"), key)
    )
    seen = 0

    def run(batch: DataFrame, number: int) -> None:
        nonlocal seen
        with scratch(spark):
            asked = staged(batch, "batch")
            seen += asked.count()
            rows = answer(asked.select(key).where(F.col(key).isNotNull()).distinct())
            rows = rows.select(F.col(answered).alias("_key"), F.struct("rank", *fields).alias("item")).distinct()
            lists = rows.groupBy("_key").agg(F.array_sort(F.collect_list("item")).alias("items"))
            found = asked.join(lists, asked[key] == lists["_key"], "left").select(
                "file", key,
                F.transform(
                    F.coalesce("items", F.array().cast(lists.schema["items"].dataType)),
                    lambda x: F.struct(*[x[f].alias(f) for f in fields]),
                ).alias("items"),
            )
            found.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{answers}/batch={number}")

    query = (
        stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return seen
