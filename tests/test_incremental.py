import json

import pytest
from pyspark.sql import functions as F

from shelfwise.plans import load, recommend
from shelfwise.sources.raw import read_raw
from shelfwise.sources.versions import published, segments


def document(name, features, *reviews, **fields):
    return {"ProductInfo": {"ProductID": name, "Name": f"name of {name}", "Features": features} | fields, "Reviews": list(reviews)}


def review(author, i, overall="4.0"):
    return {"Author": author, "Content": "c", "Date": "June 5, 2010", "Overall": overall, "ReviewID": f"r{i}", "Title": None}


FIRST = [
    document("P1", "red shoe red", review("ann", 1), review("bob", 2)), document("P2", "blue shoe", review("ann", 3)),
    document("P3", "green hat", review("eve", 4, "None")), document("P4", "only here vanishing words"), document("P4", None),
]
SECOND = [
    document("P2", "blue blue boot", review("ann", 3), review("cat", 5)),  # a new text, a review met before
    document("P5", "red hat", review("bob", 6), review("eve", 4, "None")), document("P4", "other words now"),
    {"ProductInfo": {"Name": "no id"}},
]
THIRD = [document("P2", "yellow", review("dan", 7)), document("P1", "red shoe red", review("ann", 1))]


@pytest.fixture
def raw_of(spark, tmp_path):
    def build(documents, name):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.json").write_text("\n".join(map(json.dumps, documents)))
        return read_raw(spark, str(tmp_path / name))

    return build


def rows(df):
    return sorted(str(r) for r in df.drop("_bucket").collect())


def store(spark, path):
    tables, index = load.read_tables(spark, path), load.read_products_index(spark, path)
    parts = {t: rows(getattr(tables, t)) for t in ("products", "users", "reviews")}
    columns = {"postings": ["id", "field", "term", "tf", "dl"], "terms": ["field", "term", "df", "occurrences"],
               "stats": ["field", "n_docs", "avgdl", "n_postings"]}
    parts |= {t: rows(getattr(index, t).select(*c)) for t, c in columns.items()}
    return parts | {"forward": rows(index.forward.select(*columns["postings"]))}


def test_additions_equal_one_load(spark, raw_of, tmp_path):
    whole, grown = str(tmp_path / "whole"), str(tmp_path / "grown")
    load.load(raw_of(FIRST + SECOND + THIRD, "all"), whole)
    load.load(raw_of(FIRST, "first"), grown)
    before = load.read_products_index(spark, grown)
    drops = load.add(raw_of(SECOND, "second"), grown)
    assert (drops["documents"], drops["no_product"], drops["kept"]) == (4, 1, 4)
    load.add(raw_of(THIRD, "third"), grown)
    assert len(segments(spark, f"{grown}/catalog")) == 3
    assert store(spark, grown) == store(spark, whole)
    asked = spark.createDataFrame([(1, "red hat shoe"), (2, "vanishing boot")], "key int, text string")
    answers = [rows(recommend.by_text(asked, load.read_products_index(spark, p), digits=6)) for p in (grown, whole)]
    assert answers[0] == answers[1] and answers[0]
    assert before.postings.where("term = 'blue'").count() == 1  # an opened index stays
    load.merge(spark, grown)
    assert len(segments(spark, f"{grown}/catalog")) == 1 and store(spark, grown) == store(spark, whole)


def test_files_that_are_still_read_are_kept(spark, raw_of, tmp_path):
    path = str(tmp_path / "store")
    load.load(raw_of(FIRST, "first"), path)
    for k in range(4):
        load.add(raw_of([document(f"Q{k}", f"thing {k}")], f"more{k}"), path)
    assert load.read_tables(spark, path).products.count() == 9
    load.merge(spark, path)
    for k in range(3):
        load.load(raw_of([document(f"Z{k}", "z")], f"new{k}"), path)
    assert len(published(spark, f"{path}/catalog")) == 3
    assert load.read_tables(spark, path).products.count() == 1


def test_an_addition_that_fails_leaves_the_store(spark, raw_of, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    load.load(raw_of(FIRST, "first"), path)
    before = store(spark, path)
    monkeypatch.setattr(load, "write_index_delta", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        load.add(raw_of(SECOND, "second"), path)
    assert store(spark, path) == before


def test_nothing_to_add_and_nothing_before(spark, raw_of, tmp_path):
    path, raw = str(tmp_path / "store"), raw_of(FIRST, "first")
    load.load(raw.where("false"), path)
    load.add(raw, path)
    load.add(raw.where("false"), path)
    whole = str(tmp_path / "whole")
    load.load(raw, whole)
    assert store(spark, path) == store(spark, whole)
    assert load.read_products_index(spark, path).stats.where(F.col("n_docs") <= 0).count() == 0
