"""Load stage: raw documents to stored tables and a text index."""

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Observation, SparkSession

from shelfwise.operators import normalize
from shelfwise.operators.text_index import TextIndex, read_index, with_delta, write_index, write_index_delta
from shelfwise.sources.tables import read_table, write_table
from shelfwise.sources.versions import current, publishing, segments
from shelfwise.session import scratch, staged
from shelfwise import schemas

CATALOG = "catalog"


@dataclass(frozen=True)
class Tables:
    products: DataFrame
    users: DataFrame
    reviews: DataFrame


def normalized(raw: DataFrame) -> Tables:
    """The three flat tables, as plans over ``raw``."""
    accepted = normalize.accepted_reviews(raw)
    return Tables(normalize.products(raw), normalize.users(accepted), normalize.reviews(accepted))


def write_tables(raw: DataFrame, path: str) -> dict[str, int]:
    """Write ``products``, ``users`` and ``reviews`` under ``path``.

    The parsed documents are written once and read column-wise by each table, so the raw text is
    parsed a single time; the same pass counts what it drops, by cause (``normalize.CAUSES``).
    """
    drops = Observation()
    with scratch(raw.sparkSession):
        parsed = staged(normalize.accounted_documents(raw, drops), "parsed")
        accepted = normalize.accounted_reviews(parsed)
        write_table(normalize.accounted_products(parsed), f"{path}/products", "id", also=("extId",))
        write_table(normalize.users(accepted), f"{path}/users", "id", also=("extId",))
        write_table(normalize.reviews(accepted), f"{path}/reviews", "productId", also=("userId",))
    return {cause: n or 0 for cause, n in drops.get.items()}


def load(raw: DataFrame, path: str) -> dict[str, int]:
    """Publish the three tables and the text ``index`` of the products under ``path``, and say what
    was dropped.

    A load is a version of its own (``sources.versions``): readers have the one before until all is
    written.
    """
    spark = raw.sparkSession
    with publishing(spark, f"{path}/{CATALOG}") as folder:
        drops = write_tables(raw, folder)
        write_index(read_tables(spark, folder).products, f"{folder}/index")
    return drops


def add(raw: DataFrame, path: str) -> dict[str, int]:
    """Publish the store at ``path`` with further documents, as if all had been loaded together, and
    say what of these was dropped.

    Written are the rows that the new documents add: products as they are, users and reviews that the
    store has not got, and the index entries of the new documents' ids, which replace those before. The
    version reads the older ones' files beside its own until ``merge`` writes one of a piece.
    """
    spark = raw.sparkSession
    folders = _segments(spark, path)
    old = read_tables(spark, path)
    drops = Observation()
    with publishing(spark, f"{path}/{CATALOG}", upon=folders) as folder, scratch(spark):
        parsed = staged(normalize.accounted_documents(raw, drops), "parsed")
        accepted = normalize.accounted_reviews(parsed)
        write_table(normalize.accounted_products(parsed), f"{folder}/products", "id", also=("extId",))
        write_table(_missing(normalize.users(accepted), old.users), f"{folder}/users", "id", also=("extId",))
        reviews = _missing(normalize.reviews(accepted), old.reviews)
        write_table(reviews, f"{folder}/reviews", "productId", also=("userId",))
        new = read_table(spark, f"{folder}/products", schemas.PRODUCT)
        # Which of the rows with one id the index holds is decided among all of them, old and new.
        changed = new.unionByName(old.products.join(new.select("id").distinct(), "id", "left_semi"))
        write_index_delta(read_products_index(spark, path), changed, f"{folder}/index")
    return {cause: n or 0 for cause, n in drops.get.items()}


def _missing(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """The rows that ``stored`` has not got; nulls equal nulls."""
    same = [rows[c].eqNullSafe(stored[c]) for c in rows.columns]
    return rows.join(stored, reduce(and_, same), "left_anti")


def merge(spark: SparkSession, path: str) -> None:
    """Publish the store as a version of a piece, which reads no other's files."""
    tables, index = read_tables(spark, path), read_products_index(spark, path)
    with publishing(spark, f"{path}/{CATALOG}") as folder:
        write_table(tables.products, f"{folder}/products", "id", also=("extId",))
        write_table(tables.users, f"{folder}/users", "id", also=("extId",))
        write_table(tables.reviews, f"{folder}/reviews", "productId", also=("userId",))
        write_table(index.forward, f"{folder}/index/forward", "id")
        write_table(index.postings, f"{folder}/index/postings", "term", "field")
        write_table(index.terms, f"{folder}/index/terms", "term", "field")
        write_table(index.stats, f"{folder}/index/stats")


def _segments(spark: SparkSession, path: str) -> list[str]:
    """The folders of a published store's current version, or the plain folder of tables."""
    folder = f"{path}/{CATALOG}"
    return segments(spark, folder) if current(spark, folder) != folder else [path]


def read_tables(spark: SparkSession, path: str) -> Tables:
    folders = _segments(spark, path)

    def table(name, schema):
        return reduce(DataFrame.unionByName, [read_table(spark, f"{f}/{name}", schema) for f in folders])

    return Tables(
        table("products", schemas.PRODUCT), table("users", schemas.USER), table("reviews", schemas.REVIEW)
    )


def read_products_index(spark: SparkSession, path: str) -> TextIndex:
    first, *later = _segments(spark, path)
    index = read_index(spark, f"{first}/index")
    for folder in later:
        index = with_delta(index, spark, f"{folder}/index")
    return index
