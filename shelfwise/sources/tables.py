"""Stored tables as parquet folders."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

BUCKET = "_bucket"
# Bytes that a folder of a keyed table should hold, and the most folders of a table.
FOLDER_BYTES, MOST_FOLDERS = 16 << 20, 8192


def bucket_of(key: str, folders: int | Column) -> Column:
    """The folder of a key in a table of so many; it tells their number, too."""
    folders = F.lit(folders).cast("int") if isinstance(folders, int) else folders
    return folders * (2 * MOST_FOLDERS) + F.pmod(F.xxhash64(key), folders).cast("int")


def folders_for(size: int) -> int:
    """A power of two: one folder for a small table, then enough to hold ``FOLDER_BYTES`` each, up to
    the most; from there on the folders grow."""
    wanted = max(1, -(-size // FOLDER_BYTES))
    return min(MOST_FOLDERS, 1 << (wanted - 1).bit_length())


def estimated_bytes(df: DataFrame) -> int:
    """What the optimizer expects of the size; only the number of folders depends on it."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def write_table(
    df: DataFrame, path: str, *key: str, also: tuple[str, ...] = (), folders: int | None = None
) -> None:
    """Replace the table at ``path``.

    With a ``key`` its first column's hash names a folder, so that a lookup by key reads the folders
    of its keys, and within a file rows lie in key order, so that row groups are skipped by their
    statistics. The number of folders follows the size, or is given as a power of two in ``folders``. Rebalancing
    deals the rows out by folder in one pass and cuts a folder that is large or that a hot key fills into
    several files. Columns named in ``also`` get Bloom filters, by which a lookup of
    their values skips row groups whatever the order of rows.
    """
    blooms = {f"parquet.bloom.filter.enabled#{c}": "true" for c in also}
    df = df.drop(BUCKET)
    if not key:
        df.write.mode("overwrite").options(**blooms).parquet(path)
        return
    bucket = bucket_of(key[0], folders or folders_for(estimated_bytes(df)))
    dealt = df.withColumn(BUCKET, bucket).hint("rebalance", F.col(BUCKET))
    ordered = dealt.sortWithinPartitions(BUCKET, *key)
    ordered.write.mode("overwrite").options(**blooms).partitionBy(BUCKET).parquet(path)
    if not _has_folders(df.sparkSession, path):  # of no rows; a file without any still tells the columns
        df.limit(0).write.mode("overwrite").parquet(path)


def _has_folders(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place)
    return any(status.isDirectory() for status in found)


def of_keys(table: DataFrame, keys: DataFrame) -> DataFrame:
    """The part of a stored table that can hold the one-column ``keys``, of its key column.

    The folders of the keys, a small set however many there are, prune the table while the query runs.
    They are named for every number of folders that a table may have, so that nothing has to be known
    about the table. One that was not written by key is returned as it is.
    """
    if BUCKET not in table.columns:
        return table
    (key,) = keys.columns
    counts = F.array(*[F.lit(1 << k) for k in range(MOST_FOLDERS.bit_length())])
    wanted = keys.where(F.col(key).isNotNull()).select(key, F.explode(counts).alias("_folders"))
    buckets = wanted.select(bucket_of(key, F.col("_folders")).alias(BUCKET)).distinct()
    return table.join(F.broadcast(buckets.where(F.col(BUCKET) >= 0)), BUCKET, "left_semi")


def read_table(
    spark: SparkSession, path: str, schema: StructType | None = None, keyed: bool = False
) -> DataFrame:
    """The table; with ``keyed`` also its bucket column, which ``of_keys`` needs."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    table = reader.parquet(path)
    return table if keyed else table.drop(BUCKET)
