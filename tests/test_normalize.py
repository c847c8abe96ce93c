import json

import pytest
from pyspark.sql import Observation, functions as F

from shelfwise.functions.reviews import MONTHS, review_date
from shelfwise.operators import normalize
from shelfwise.operators.ratings import build_ratings, distinct_ids
from shelfwise.plans.load import load, normalized, read_products_index, read_tables
from shelfwise.schemas import PRODUCT, REVIEW, USER
from shelfwise.session import scratch_path
from shelfwise.sources.raw import read_raw


def review(**changes):
    base = dict(
        Author="Ann", Content="fine", Date="February 03, 2010", Overall="5.0", ReviewID="R1", Title="t"
    )
    return {k: v for k, v in {**base, **changes}.items()}


def document(*reviews, product="P1", **info):
    return {"ProductInfo": {"ProductID": product, "Name": "n", **info}, "Reviews": list(reviews)}


@pytest.fixture
def raw_of(spark, tmp_path):
    def make(*documents):
        folder = tmp_path / "raw"
        folder.mkdir(exist_ok=True)
        (folder / "a.json").write_text("\n".join(json.dumps(d) for d in documents))
        return read_raw(spark, str(folder))

    return make


def counts(tables):
    return tables.products.count(), tables.users.count(), tables.reviews.count()


def test_documents_without_key_go_with_their_reviews(raw_of):
    raw = raw_of(
        {"ProductInfo": None, "Reviews": [review()]},
        {"Reviews": [review()]},
        {"ProductInfo": {"Name": "n"}, "Reviews": [review()]},
    )
    assert counts(normalized(raw)) == (0, 0, 0)


def test_documents_without_reviews_keep_the_product(raw_of):
    assert counts(normalized(raw_of(document(), {"ProductInfo": {"ProductID": "P2"}, "Reviews": None}))) == (2, 0, 0)


@pytest.mark.parametrize(
    "bad",
    [
        None, review(Author=None), review(Date="garbage"), review(Overall=None), review(Overall=""),
        review(Overall="five"),
    ],
)
def test_a_bad_review_goes_alone(raw_of, bad):
    if bad:
        bad["Author"] = bad["Author"] and "Bad"
    tables = normalized(raw_of(document(bad, review())))
    assert counts(tables) == (1, 1, 1)
    assert tables.users.first()["extId"] == "Ann"


def test_nulls_that_stay(raw_of):
    tables = normalized(
        raw_of(document(review(Date=None, ReviewID=None, Title=None, Content=None), review(Overall="None")))
    )
    rows = {r["reviewId"]: r for r in tables.reviews.collect()}
    assert rows[None]["date"] is None and rows[None]["overall"] == 5.0
    assert rows["R1"]["overall"] is None and rows["R1"]["date"] is not None
    assert build_ratings(tables.reviews).count() == 1


def test_not_a_number_rating_is_no_training_row(raw_of):
    tables = normalized(raw_of(document(review(Overall="NaN"))))
    assert tables.reviews.count() == 1 and build_ratings(tables.reviews).count() == 0


def test_repeats(raw_of):
    tables = normalized(
        raw_of(document(review(), review()), document(review()), document(review(), product="P2"))
    )
    # Products stay as met, reviews and users are distinct.
    assert counts(tables) == (3, 1, 2)
    assert distinct_ids(tables.products).count() == 2


def test_names_that_share_an_id(raw_of):
    tables = normalized(raw_of(document(review(Author="Aa"), review(Author="BB"))))
    assert tables.users.count() == 2 and distinct_ids(tables.users).count() == 1
    assert [tuple(r) for r in normalize.id_collisions(tables.users).collect()] == [(2112, 2)]


def test_schemas_and_stored_tables(spark, raw_of):
    raw = raw_of(document(review(), Features="good red shoe", Price="3.50", ImgURL="u"), document())
    path = scratch_path(spark, "test")
    load(raw, path)
    load(raw, path)
    stored = read_tables(spark, path)
    fresh = normalized(raw)
    for kept, built, schema in (
        (stored.products, fresh.products, PRODUCT),
        (stored.users, fresh.users, USER),
        (stored.reviews, fresh.reviews, REVIEW),
    ):
        assert [f.dataType for f in built.schema] == [f.dataType for f in schema]
        assert sorted(map(str, kept.collect())) == sorted(map(str, built.collect()))
    index = read_products_index(spark, path)
    # Of the two product rows with one id, the text index holds one.
    assert index.postings.select("id").distinct().count() == 1


def test_a_field_absent_from_all_files_reads_as_null(raw_of):
    row = normalized(raw_of({"ProductInfo": {"ProductID": "P1"}})).products.first()
    assert row["price"] is None and row["extId"] == "P1"


def test_reviews_are_parsed_out_of_their_array(raw_of):
    raw = raw_of(
        document(None, review(), review(Date="garbage"), review(Author=None, Overall="five")),
        document(review(Overall="five"), review(ReviewID="R2"), product="P2"), document(product="P3"),
        {"ProductInfo": {"ProductID": "P4"}, "Reviews": None}, {"Reviews": [review()]},
    )
    drops = Observation()
    parsed, accepted = normalize.accounted_documents(raw, drops), normalize.accepted_reviews(raw)
    for df in (parsed, accepted):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "posexplode" in plan and "transform(Reviews" not in plan and "filter(Reviews" not in plan
    rows = parsed.select("product.extId", "review.reviewId").collect()
    assert sorted(r[0] for r in rows if r[0]) == ["P1", "P2", "P3", "P4"]
    assert sorted(r[1] for r in rows if r[1]) == ["R1", "R2"]
    assert drops.get == {
        "documents": 5, "corrupt": 0, "no_product": 1, "reviews": 6, "no_review": 1, "no_author": 1, "bad_rating": 1,
        "bad_date": 1, "kept": 2,
    }
    assert sorted(map(str, normalize.accounted_reviews(parsed).collect())) == sorted(map(str, accepted.collect()))


def test_all_names_of_months(spark):
    names = [(i + 1, name) for i, m in enumerate(MONTHS) for name in (m, m[:3], m.upper())]
    df = spark.createDataFrame([(i, f"{name} 3, 2010") for i, name in names], "i int, t string")
    assert all(i == month for i, month in df.select("i", F.month(review_date(F.col("t")))).collect())
