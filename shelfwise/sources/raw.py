"""Raw product-review files."""

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from shelfwise.schemas import RAW_DOCUMENT

#: Column with the text of a line that is no JSON object.
CORRUPT = "_corrupt_record"


def read_raw(spark: SparkSession, folder: str, file: str | None = None) -> DataFrame:
    """All ``*.json`` and ``*.json.gz`` of a folder, files or folders of files, or one that is named.

    The fixed schema saves the inference pass. A line that is no JSON object is a row of nulls with its
    text in ``CORRUPT``.
    """
    schema = StructType([*RAW_DOCUMENT.fields, StructField(CORRUPT, StringType())])
    reader = spark.read.schema(schema).option("columnNameOfCorruptRecord", CORRUPT)
    return reader.json(f"{folder.rstrip('/')}/{file or '*.{json,json.gz}'}")


def compact_small_files(spark: SparkSession, source: str, target: str) -> None:
    """Gather the many JSON files of each first-level directory into few large text files.

    A directory becomes ``category=<name>.json`` under ``target``, so that ``read_raw`` of the target
    reads them all and a name made of digits stays a text. Rebalancing joins small pieces and splits
    a category that is larger than one task should write; the source stays as it is. Files compressed by
    gzip are read, too, and what is written is compressed, as text shrinks to a tenth.
    """
    path = F.col("_metadata.file_path")
    category = F.url_decode(F.regexp_replace(F.element_at(F.split(path, "/"), -2), r"\+", "%2B"))
    lines = spark.read.text(f"{source.rstrip('/')}/*/*.{{json,json.gz}}").select(
        "value", F.concat(category, F.lit(".json")).alias("category")
    )
    lines.hint("rebalance", F.col("category")).write.mode("overwrite").partitionBy(
        "category"
    ).text(target, compression="gzip")
