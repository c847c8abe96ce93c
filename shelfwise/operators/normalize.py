"""Raw documents to flat products, users and reviews."""

from pyspark.sql import DataFrame, Observation, functions as F

from shelfwise.functions.ids import string_id
from shelfwise.functions.reviews import NO_RATING, date_of, date_parts, review_rating
from shelfwise.sources.raw import CORRUPT


#: Why a review goes, in the order in which the causes are looked at.
CAUSES = ("no_review", "no_author", "bad_rating", "bad_date")


#: Of a review that stays.
REVIEW_COLUMNS = ("author", "reviewId", "userId", "productId", "title", "overall", "content", "date")


def _info():
    return F.col("ProductInfo")


def _product():
    info = _info()
    return F.struct(
        string_id(info.ProductID).alias("id"),
        info.ProductID.alias("extId"),
        info.Name.alias("name"),
        info.Price.alias("price"),
        info.Features.alias("features"),
        info.ImgURL.alias("imgUrl"),
    )


def judged_reviews(raw: DataFrame) -> DataFrame:
    """One row per review, with the ``cause`` for which it goes or null, and one, whose ``pos`` is null,
    for a document without reviews or without a product id.

    Reviews are taken out of their array before they are parsed, as Spark compiles expressions over
    columns but not those over the elements of an array. ``product`` stands on the first row of its
    document; ``stays`` says whether there is a product id.
    """
    corrupt = F.col(CORRUPT).isNotNull() if CORRUPT in raw.columns else F.lit(False)
    stays = _info().ProductID.isNotNull() & ~corrupt
    documents = raw.select(corrupt.alias("corrupt"), stays.alias("stays"), _product().alias("product"), "Reviews")
    r, first = F.col("r"), F.coalesce(F.col("pos") == 0, F.lit(True))
    parsed = documents.select(
        "corrupt", "stays", "product", F.posexplode_outer(F.when(F.col("stays"), F.col("Reviews"))).alias("pos", "r")
    ).select(
        "corrupt", "stays", "pos", first.alias("first"),
        F.when(first & F.col("stays"), F.col("product")).alias("product"), F.col("product.id").alias("productId"),
        r.isNull().alias("missing"), (r.Overall == NO_RATING).alias("unrated"), r.Date.isNull().alias("undated"),
        r.Author.alias("author"), r.ReviewID.alias("reviewId"), string_id(r.Author).alias("userId"),
        r.Title.alias("title"), review_rating(r.Overall).alias("overall"), r.Content.alias("content"),
        *date_parts(r.Date),
    )
    accepted, date = date_of(F.col("name"), F.col("day"), F.col("year"))
    rated = F.col("unrated") | F.col("overall").isNotNull()
    cause = (
        F.when(F.col("missing"), CAUSES[0]).when(F.col("author").isNull(), CAUSES[1])
        .when(~F.coalesce(rated, F.lit(False)), CAUSES[2]).when(~(F.col("undated") | accepted), CAUSES[3])
    )
    return parsed.select(
        "corrupt", "stays", "first", "pos", "product", cause.alias("cause"),
        "author", "reviewId", "userId", "productId", "title", "overall", "content", date,
    )


def accounted_documents(raw: DataFrame, drops: Observation) -> DataFrame:
    """``product, review``: the accepted reviews, one per row, and the product record of each document on
    one row. ``drops`` counts in the same pass what goes and why.

    Documents without a product id go, with all their reviews. ``drops.get`` has, once the result is
    written: ``documents`` read, ``corrupt`` ones (no JSON, where ``raw`` has the column ``raw.CORRUPT``),
    ``no_product`` (no product id), ``reviews`` of the documents that stay, how many of these went by each
    of ``CAUSES`` (the first that holds), and ``kept``.
    """
    observed = judged_reviews(raw).observe(
        drops,
        F.count_if("first").alias("documents"),
        F.count_if(F.col("first") & F.col("corrupt")).alias("corrupt"),
        F.count_if(F.col("first") & ~F.col("stays") & ~F.col("corrupt")).alias("no_product"),
        F.count("pos").alias("reviews"),
        *[F.count_if((F.col("cause") == cause) & F.col("pos").isNotNull()).alias(cause) for cause in CAUSES],
        F.count_if(_kept()).alias("kept"),
    )
    review = F.when(_kept(), F.struct(*REVIEW_COLUMNS))
    return observed.select("product", review.alias("review")).where("product IS NOT NULL OR review IS NOT NULL")


def _kept():
    return F.col("pos").isNotNull() & F.col("cause").isNull()


def products(raw: DataFrame) -> DataFrame:
    """One row per document with a product id; a product met in two documents stays twice."""
    return raw.where(_info().ProductID.isNotNull()).select(_product().alias("product")).select("product.*")


def accounted_products(parsed: DataFrame) -> DataFrame:
    """As ``products``, of ``accounted_documents``."""
    return parsed.where("product IS NOT NULL").select("product.*")


def accepted_reviews(raw: DataFrame) -> DataFrame:
    """Reviews that survive parsing, one per row, still with the author's name.

    Dropped: a null review, a null author, a date text that is no date, and a rating that is
    neither "None" nor a number. A null date and a "None" rating stay, as null values, and so does
    a date beyond all timestamps.
    """
    return judged_reviews(raw.drop(CORRUPT)).where(_kept()).select(*REVIEW_COLUMNS)


def accounted_reviews(parsed: DataFrame) -> DataFrame:
    """As ``accepted_reviews``, of ``accounted_documents``."""
    return parsed.where("review IS NOT NULL").select("review.*")


def users(accepted: DataFrame) -> DataFrame:
    """Distinct authors over all documents."""
    return accepted.select(F.col("userId").alias("id"), F.col("author").alias("extId")).distinct()


def reviews(accepted: DataFrame) -> DataFrame:
    """Reviews distinct over all their columns."""
    return accepted.select(
        "reviewId", "userId", "productId", "title", "overall", "content", "date"
    ).distinct()


def id_collisions(names: DataFrame, name: str = "extId") -> DataFrame:
    """Ids that more than one name shares."""
    return (
        names.select(F.col(name).alias("name"))
        .distinct()
        .groupBy(string_id(F.col("name")).alias("id"))
        .agg(F.count("*").alias("names"))
        .where("names > 1")
    )
