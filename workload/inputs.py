"""Raw documents, vectors, catalogs and requests derived from the given tables.

A raw document holds the reviews a product got in one batch of orders. Batches are ranges of
``ORDERS_PER_BATCH`` order keys, so the reviews gathered into one document stay bounded however
often a product is sold; a product sold in several batches occurs in several documents.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

ORDERS_PER_BATCH = 10_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _lines(spark, folder):
    """Order lines with their customer, placed by the product they belong to.

    Placing them while they are slim leaves the text building and the gathering to all tasks, and the
    documents, which are wide, meet their products where they are gathered. Orders, which are fewer, get
    their customers first, so that lines travel once for both.
    """
    lines = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, folder, "customer").select("c_custkey", "c_name")
    named = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name")
    return (
        lines.join(named, F.col("l_orderkey") == F.col("o_orderkey"))
        .withColumn("batch", F.expr(f"l_orderkey div {ORDERS_PER_BATCH}"))
        .repartition("l_partkey")
    )


def _product_info(spark, folder):
    return table(spark, folder, "part").select(
        "p_partkey", "p_size",
        F.concat_ws(" ", "p_name", "p_brand", "p_type").alias("Features"),
        F.concat(F.lit("http://img.example.com/"), "p_partkey").alias("ImgURL"),
        F.col("p_name").alias("Name"),
        F.col("p_retailprice").cast("decimal(12,2)").cast("string").alias("Price"),
        F.concat(F.lit("P"), "p_partkey").alias("ProductID"),
    )


def _documents(products, reviews, info):
    nested = reviews.groupBy("l_partkey", "batch").agg(
        F.collect_list(F.struct("Author", "Content", "Date", "Overall", "ReviewID", "Title")).alias("Reviews")
    )
    return products.join(nested, F.col("p_partkey") == F.col("l_partkey"), "left").select(
        info.alias("ProductInfo"), "Reviews"
    )


def _stars():
    return F.concat(F.floor((F.col("l_quantity") - 1) / 10) + 1, F.lit(".0"))


def _review_columns(author, date, overall):
    return [
        "l_partkey", "batch",
        author.alias("Author"),
        F.concat_ws(" ", "l_returnflag", "l_linestatus").alias("Content"),
        date.alias("Date"),
        overall.alias("Overall"),
        F.concat(F.lit("R"), "l_orderkey", F.lit("-"), "l_linenumber").alias("ReviewID"),
        F.concat("l_returnflag", "l_linestatus").alias("Title"),
    ]


def raw_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Clean documents; reviews on line 7 carry no rating."""
    overall = F.when(F.col("l_linenumber") == 7, "None").otherwise(_stars())
    reviews = _lines(spark, folder).select(
        *_review_columns(F.col("c_name"), F.date_format("l_shipdate", "MMMM dd, yyyy"), overall)
    )
    info = F.struct("Features", "ImgURL", "Name", "Price", "ProductID")
    return _documents(_product_info(spark, folder), reviews, info)


def dirty_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents whose fields are spoilt by rules over the source columns."""
    long_date = F.date_format("l_shipdate", "MMMM dd, yyyy")
    year = F.date_format("l_shipdate", "yyyy")
    kind = F.col("l_suppkey") % 10
    dates = {
        0: F.lit(None).cast("string"),
        1: F.lit("garbage"),
        2: F.date_format("l_shipdate", "MMM dd, yyyy"),
        3: F.lower(long_date),
        4: F.concat(long_date, F.lit(" extra")),
        5: F.concat(F.lit("February 30, "), year),
        6: F.date_format("l_shipdate", "MMMM d, yyyy"),
        7: F.concat(F.lit("Sept 1, "), year),
        8: F.date_format("l_shipdate", "MMMM dd,yyyy"),
    }
    far = {1: "June 5, 0", 2: "June 5, -5", 3: "June 5, 200001", 4: "June 1000001, 2010", 5: "June 5, 9999999"}
    ratings = {1: "None", 2: None, 3: "five", 4: " 4 ", 5: "5d", 6: "", 7: "nan"}
    is_far = (kind == 9) & (F.col("l_orderkey") % 3 == 0)
    date = F.coalesce(
        *[F.when(kind == k, v) for k, v in dates.items() if k],
        *[F.when(is_far & (F.col("l_linenumber") == n), F.lit(v)) for n, v in far.items()],
        F.when(kind != 0, long_date),
    )
    overall = _stars()
    for line, text in ratings.items():
        spoilt = (F.col("l_linenumber") == line) & (F.col("l_quantity") < 40)
        overall = F.when(spoilt, F.lit(text)).otherwise(overall)
    tabbed = (F.col("l_quantity") < 20) & F.col("l_linenumber").isin(3, 7)
    overall = F.when(tabbed, F.when(F.col("l_linenumber") == 3, "\tinf").otherwise("\tnan")).otherwise(overall)
    author = F.when(~((F.col("l_returnflag") == "N") & (F.col("l_quantity") > 45)), F.col("c_name"))
    reviews = _lines(spark, folder).select(*_review_columns(author, date, overall))
    info = F.when(
        F.col("p_size") != 7,
        F.struct(
            "Features", "ImgURL", "Name", "Price",
            F.when(F.col("p_size") != 8, F.col("ProductID")).alias("ProductID"),
        ),
    )
    documents = _documents(_product_info(spark, folder), reviews, info)
    with_gap = F.concat("Reviews", F.array(F.lit(None).cast(documents.schema["Reviews"].dataType.elementType)))
    return documents.withColumn("Reviews", with_gap)


def catalog(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as products: the first line is the name, the whole text the features."""
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"),
        F.split("text", "\n")[0].alias("name"),
        F.col("text").alias("features"),
    )


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("features")
    )


def text_requests(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "benchmark").select(F.col("item_id").alias("key"), "text")


def product_requests(spark: SparkSession, folder: str) -> DataFrame:
    """One request per part; many are unknown to the vector table."""
    return table(spark, folder, "part").select(F.col("p_partkey").alias("productId"))


def document_requests(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(F.col("doc_id").alias("productId"))


def user_requests(spark: SparkSession, folder: str) -> DataFrame:
    """One request per customer; many are unknown to the vector table."""
    return table(spark, folder, "customer").select(F.col("c_custkey").alias("userId"))
