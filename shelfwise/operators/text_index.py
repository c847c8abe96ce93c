"""Term tables over a product catalog, for relevance search."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from shelfwise.functions.text import tokens
from shelfwise.session import parallelism, scratch_path, staged
from shelfwise.sources.tables import BUCKET, of_keys, read_table, write_table

FIELDS = ("name", "features")
# Text whose terms one task counts, on average.
TEXT_PER_TASK = 16 << 20


@dataclass(frozen=True)
class TextIndex:
    """``postings(id, field, term, tf, dl)`` by term, the same rows ``forward`` by document,
    ``terms(field, term, df, occurrences, max_tf, min_dl)`` and ``stats(field, ...)``."""

    postings: DataFrame
    forward: DataFrame
    terms: DataFrame
    stats: DataFrame


def one_per_id(catalog: DataFrame) -> DataFrame:
    """The document key is ``id``: of rows with one id a single one stays, the least by the hash of
    its columns and, where hashes tie, by the columns themselves."""
    others = [c for c in catalog.columns if c != "id"]
    w = Window.partitionBy("id").orderBy(F.xxhash64(*others), *others)
    return catalog.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def text_parts(catalog: DataFrame, fields=FIELDS) -> int:
    """Tasks for the text of a catalog: the session's width, more where one would get ``TEXT_PER_TASK``."""
    lengths = [F.coalesce(F.octet_length(F.col(f).cast("string")), F.lit(0)) for f in fields]
    size = catalog.agg(F.sum(sum(lengths[1:], lengths[0]).cast("long"))).first()[0] or 0
    return max(parallelism(catalog.sparkSession), -(-size // TEXT_PER_TASK))


def postings(catalog: DataFrame, fields=FIELDS) -> DataFrame:
    """Term counts per document and field.

    Documents are dealt out by ``id`` to as many tasks as their text asks for, so that what a task sorts
    and counts stays bounded however large the catalog is. Making ids unique and counting by (id, field,
    term) are satisfied with that, so they take no further shuffle. The outer explode
    keeps the optimizer from testing the number of tokens, which would split each text twice.
    """
    texts = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in fields])
    return (
        one_per_id(catalog.select("id", *fields).repartition(text_parts(catalog, fields), "id"))
        .select("id", F.explode(texts).alias("x"))
        .select("id", "x.field", tokens(F.col("x.text")).alias("tokens"))
        .select("id", "field", F.size("tokens").alias("dl"), F.explode_outer("tokens").alias("term"))
        .where("term IS NOT NULL")
        .groupBy("id", "field", "term")
        .agg(F.count("*").cast("int").alias("tf"), F.first("dl").alias("dl"))
    )


def term_statistics(postings: DataFrame) -> DataFrame:
    """Document frequency per field and term, with the total count of occurrences, the largest count in
    one document and the least length of a document: no posting of the term weighs more than these two
    together would."""
    return postings.groupBy("field", "term").agg(
        F.count("*").alias("df"), F.sum("tf").alias("occurrences"),
        F.max("tf").alias("max_tf"), F.min("dl").alias("min_dl"),
    )


def field_statistics(postings: DataFrame) -> DataFrame:
    """Per field the number of documents with any token, their mean length and the postings."""
    lengths = postings.groupBy("field", "id").agg(F.first("dl").alias("dl"), F.count("*").alias("n"))
    return lengths.groupBy("field").agg(
        F.count("*").alias("n_docs"), F.avg("dl").alias("avgdl"), F.sum("n").alias("n_postings")
    )


def write_index(catalog: DataFrame, path: str, fields=FIELDS) -> None:
    """Build the four tables under ``path``, replacing what was there.

    Postings are counted once, into the table by document; the one by term is a copy of it in
    another order. So a search reads the postings of its terms, and a source document its own.
    """
    spark = catalog.sparkSession
    write_table(postings(catalog, fields), f"{path}/forward", "id")
    forward = read_table(spark, f"{path}/forward")
    write_table(forward, f"{path}/postings", "term", "field")
    by_term = read_table(spark, f"{path}/postings")
    write_table(term_statistics(by_term), f"{path}/terms", "term", "field")
    write_table(field_statistics(forward), f"{path}/stats")


def write_index_delta(base: TextIndex, changed: DataFrame, path: str, fields=FIELDS) -> None:
    """Write under ``path`` what turns ``base`` into the index in which the documents of ``changed`` stand
    in place of those with their ids.

    Only the postings of changed documents are written, with the ids they replace. Document frequencies
    and lengths are corrected by what came and what went, so that no other posting is read; the tables
    of terms and of statistics, small beside the postings, are written whole. The bounds of a term's
    postings also hold for those that went, until the index is built anew.
    """
    spark = changed.sparkSession
    write_table(changed.select("id").where("id IS NOT NULL").distinct(), f"{path}/replaced", "id")
    write_table(postings(changed, fields), f"{path}/forward", "id")
    came = read_table(spark, f"{path}/forward")
    write_table(came, f"{path}/postings", "term", "field")
    replaced = read_table(spark, f"{path}/replaced")
    went = of_keys(base.forward, replaced).drop(BUCKET).join(replaced, "id", "left_semi")
    went = staged(went, "went")

    signed = [came.withColumn("sign", F.lit(1)), went.withColumn("sign", F.lit(-1))]
    moves = signed[0].unionByName(signed[1])
    per_term = moves.groupBy("field", "term").agg(
        F.sum("sign").alias("df"), F.sum(F.col("tf") * F.col("sign")).alias("occurrences"),
        F.max("tf").alias("max_tf"), F.min("dl").alias("min_dl"),
    )
    terms = base.terms.drop(BUCKET).unionByName(per_term).groupBy("field", "term").agg(
        F.sum("df").alias("df"), F.sum("occurrences").alias("occurrences"),
        F.max("max_tf").alias("max_tf"), F.min("min_dl").alias("min_dl"),
    )
    write_table(terms.where("df > 0"), f"{path}/terms", "term", "field")

    lengths = moves.groupBy("field", "id", "sign").agg(F.first("dl").alias("dl"), F.count("*").alias("n"))
    total = F.round(F.col("avgdl") * F.col("n_docs")).cast("long")
    parts = base.stats.select("field", "n_docs", total.alias("length"), "n_postings").unionByName(
        lengths.select(
            "field", F.col("sign").cast("long").alias("n_docs"), (F.col("dl") * F.col("sign")).alias("length"),
            (F.col("n") * F.col("sign")).alias("n_postings"),
        )
    )
    stats = parts.groupBy("field").agg(*[F.sum(c).alias(c) for c in ("n_docs", "length", "n_postings")])
    stats = stats.where("n_docs > 0").select(
        "field", "n_docs", (F.col("length") / F.col("n_docs")).alias("avgdl"), "n_postings"
    )
    write_table(stats, f"{path}/stats")


def with_delta(base: TextIndex, spark: SparkSession, path: str) -> TextIndex:
    """``base`` with the delta at ``path`` over it: postings of replaced documents are passed over."""
    replaced = read_table(spark, f"{path}/replaced")
    delta = read_index(spark, path)

    def over(old: DataFrame, new: DataFrame) -> DataFrame:
        kept = old.join(replaced, "id", "left_anti")
        return kept.unionByName(new, allowMissingColumns=True)  # a table of no rows has no folders

    return TextIndex(
        over(base.postings, delta.postings), over(base.forward, delta.forward), delta.terms, delta.stats
    )


def read_index(spark: SparkSession, path: str) -> TextIndex:
    return TextIndex(*(read_table(spark, f"{path}/{t}", keyed=True) for t in ("postings", "forward", "terms", "stats")))


def build_index(catalog: DataFrame, path: str | None = None, fields=FIELDS) -> TextIndex:
    """Write the index and open it; by default in the shared scratch folder."""
    spark = catalog.sparkSession
    path = path or scratch_path(spark, "index")
    write_index(catalog, path, fields)
    return read_index(spark, path)


def heavy_terms(index: TextIndex, width: int) -> DataFrame:
    """Terms that would fill whole tasks, and over how many salts to spread each.

    A term is heavy when its postings are more than one task's share at this width. There are at
    most ``width`` of them per field, whatever the size of the index, so this table may be
    broadcast; their salts together are at most twice as many.
    """
    share = F.col("df") / F.col("n_postings")
    return (
        index.terms.join(F.broadcast(index.stats), "field")
        .where(share * width > 1)
        .select("field", "term", F.ceil(share * width).cast("int").alias("salts"))
    )


def join_by_term(postings: DataFrame, by_term: DataFrame, heavy: DataFrame) -> DataFrame:
    """Inner join on (field, term), with the postings of heavy terms spread by document."""
    on = ["field", "term"]
    salts = F.coalesce("salts", F.lit(1))
    heavy = F.broadcast(heavy)
    spread = postings.join(heavy, on, "left").withColumn("salt", F.pmod(F.xxhash64("id"), salts))
    all_salts = F.sequence(F.lit(0).cast("bigint"), salts.cast("bigint") - 1)
    copies = by_term.join(heavy, on, "left").withColumn("salt", F.explode(all_salts))
    return spread.drop("salts").join(copies.drop("salts"), [*on, "salt"]).drop("salt")
