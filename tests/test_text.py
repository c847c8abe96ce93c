import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.operators import search, text_index
from shelfwise.operators.cells import Grid
from shelfwise.operators.search import bounded_relevant, leading_terms, relevant, source_terms, text_terms
from shelfwise.operators.text_index import build_index, heavy_terms

FIELDS = ["name", "features"]


def corpus(n=120):
    """Texts with one word in all of them, and a third of them copies of one text."""
    random = np.random.default_rng(5)
    words = [f"w{i}" for i in range(60)]
    out = []
    for i in range(n):
        size = int(random.integers(5, 40))
        text = " ".join(["the"] + list(random.choice(words, size, p=np.arange(60, 0, -1) / 1830)))
        out.append((i, " ".join(text.split()[:3]), text))
    return [(i, *(out[0][1:] if i % 3 == 0 else (name, text))) for i, name, text in out]


def python_index(rows):
    index = {}
    for f, field in enumerate(FIELDS):
        tf = {r[0]: Counter(re.findall(r"\w+", r[f + 1].lower())) for r in rows}
        df = Counter(t for c in tf.values() for t in c)
        dl = {i: sum(c.values()) for i, c in tf.items()}
        index[field] = tf, df, dl, np.mean([x for x in dl.values() if x])
    return index


def python_score(index, field, terms, doc):
    tf, df, dl, avgdl = index[field]
    n = sum(1 for x in dl.values() if x)
    score, matched = 0.0, 0
    for t in terms:
        if tf[doc][t]:
            matched += 1
            idf = math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5))
            score += idf * tf[doc][t] * 2.2 / (tf[doc][t] + 1.2 * (0.25 + 0.75 * dl[doc] / avgdl))
    return score, matched


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def index(spark, rows):
    return build_index(spark.createDataFrame(rows, "id long, name string, features string"))


def lists(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["id"], []).append((-r["r"], r["pid"]))
    return {i: sorted(v) for i, v in out.items()}


def test_index_counts(rows, index):
    expected = python_index(rows)
    for field in FIELDS:
        tf, df, dl, avgdl = expected[field]
        got = index.postings.where(f"field = '{field}'").collect()
        assert {(r["id"], r["term"]): (r["tf"], r["dl"]) for r in got} == {
            (i, t): (n, dl[i]) for i, c in tf.items() for t, n in c.items()
        }
        assert {r["term"]: r["df"] for r in index.terms.where(f"field = '{field}'").collect()} == dict(df)
        stats = index.stats.where(f"field = '{field}'").first()
        assert stats["n_docs"] == len(rows) and stats["avgdl"] == pytest.approx(avgdl)


def test_frequent_terms_are_spread(index):
    heavy = {r["term"]: r["salts"] for r in heavy_terms(index, 1000).where("field = 'features'").collect()}
    assert heavy["the"] == max(heavy.values()) > 10


@pytest.mark.parametrize("grid, search", [
    *[(grid, relevant) for grid in (None, Grid(1, 1), Grid(3, 1), Grid(1, 4), Grid(4, 3))],
    (None, bounded_relevant), (Grid(4, 3), bounded_relevant),
])
def test_search_equals_brute_force(spark, rows, index, grid, search):
    asked = [(7, "the w1 W3 w3"), (8, "w50 w51"), (9, "nothing here"), (10, "!?"), (11, "the")]
    expected = python_index(rows)
    want = {}
    for key, text in asked:
        terms = set(re.findall(r"\w+", text.lower()))
        scored = []
        for i, *_ in rows:
            best = max(python_score(expected, f, terms, i)[0] for f in FIELDS)
            if best > 0:
                scored.append((-round(best, 6), i))
        if scored:
            want[key] = sorted(scored)[:10]
    terms = text_terms(spark.createDataFrame(asked, "key long, text string"))
    assert lists(search(index, terms, FIELDS, 10, digits=6, grid=grid)) == want


@pytest.mark.parametrize("grid, search", [
    *[(grid, relevant) for grid in (None, Grid(1, 1), Grid(2, 3))], (Grid(2, 3), bounded_relevant),
])
def test_similar_content_equals_brute_force(rows, index, grid, search):
    expected = python_index(rows)
    tf, df, dl, _ = expected["features"]
    want = {}
    for i, *_ in rows:
        weighted = [
            (-round(n * math.log(1 + (len(rows) - df[t] + 0.5) / (df[t] + 0.5)), 6), t)
            for t, n in tf[i].items() if n >= 2 and df[t] >= 5
        ]
        terms = [t for _, t in sorted(weighted)[:6]]
        need = max(1, math.floor(len(terms) * 0.3))
        scored = []
        for j, *_ in rows:
            score, matched = python_score(expected, "features", terms, j)
            if j != i and matched >= need and score > 0:
                scored.append((-round(score, 6), j))
        if scored:
            want[i] = sorted(scored)[:10]
    terms = source_terms(index, max_query_terms=6)
    got = search(index, terms, ["features"], 10, skip_self=True, digits=6, grid=grid)
    assert lists(got) == want


def test_requests_choose_the_sources(spark, index):
    some = spark.createDataFrame([(4,), (5,), (99999,)], "productId long")
    assert {r["id"] for r in source_terms(index, some).collect()} == {4, 5}


def test_an_id_given_twice_is_indexed_once(spark):
    rows = [(1, "b", "b b"), (1, "a", "a a"), (2, None, "c")]
    index = build_index(spark.createDataFrame(rows, "id long, name string, features string"))
    got = {(r["id"], r["field"], r["term"], r["tf"]) for r in index.postings.collect()}
    assert got == {(1, "name", "a", 1), (1, "features", "a", 2), (2, "features", "c", 1)}


def test_frequent_terms_do_not_lead(spark, index):
    """Of a rare and a frequent term, and of terms of which several are needed, the frequent ones follow."""
    asked = [(1, 1, "the"), (1, 1, "w50"), (1, 1, "w55"), (2, 2, "the"), (2, 2, "w1"), (2, 2, "w50"), (3, 1, "the")]
    terms = spark.createDataFrame(asked, "id long, need int, term string")
    leading = leading_terms(index, terms, FIELDS).where("leads")
    assert {(r["id"], r["term"]) for r in leading.collect()} == {
        (1, "the"), (1, "w50"), (1, "w55"), (2, "w1"), (2, "w50"), (3, "the"),
    }
    floor = spark.createDataFrame([(1, 0.5), (2, 0.0), (3, 0.001)], "id long, floor double")
    by_floor = leading_terms(index, terms, FIELDS, floor).where("leads")
    assert {(r["id"], r["term"]) for r in by_floor.collect()} == {
        (1, "w50"), (1, "w55"), (2, "w1"), (2, "w50"), (3, "the"),
    }


def test_bounds_keep_postings_of_frequent_terms_away(spark):
    """A term in all documents and a rare one: only the documents of the rare one are taken."""
    rows = [(i, None, f"the a{i % 7} " + ("rare " * (1 + i % 3) if i % 50 == 0 else "x")) for i in range(3000)]
    index = build_index(spark.createDataFrame(rows, "id long, name string, features string"))
    terms = text_terms(spark.createDataFrame([(1, "the rare")], "key long, text string"))
    got = bounded_relevant(index, terms, ["features"], 10, digits=6)
    assert lists(got) == lists(relevant(index, terms, ["features"], 10, digits=6))
    floor = spark.createDataFrame([(1, 3.0)], "id long, floor double")
    led = leading_terms(index, terms, ["features"], floor)
    df = {(r["term"], r["leads"]): r["df"] for r in led.collect()}
    assert df == {("the", False): 3000, ("rare", True): 60}


def test_more_text_is_counted_by_more_tasks(spark, monkeypatch):
    rows = [(k, f"name {k}", "some words of a text " * 20) for k in range(400)]
    catalog = spark.createDataFrame(rows, "id long, name string, features string")
    usual = text_index.postings(catalog)
    monkeypatch.setattr(text_index, "TEXT_PER_TASK", 4_000)
    cut = text_index.postings(catalog)
    assert cut.rdd.getNumPartitions() > 20 * 8 / 4 >= usual.rdd.getNumPartitions()
    assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, usual.collect()))


def test_postings_are_shipped_to_few_blocks(spark, index):
    """Blocks are bounded by memory, not by what a processor's cache holds."""
    asked = spark.range(20_000).select("id", F.lit(1).alias("need"), F.explode(F.array(F.lit("w1"), F.lit("w2"))).alias("term"))
    assert search._grid(index, asked, FIELDS, 10, 8).blocks == 1
    many = spark.range(search.MAX_REQUESTS * 2 + 1).select("id", F.lit(1).alias("need"), F.lit("w1").alias("term"))
    assert search._grid(index, many, FIELDS, 10, 8).blocks >= 3


def test_few_requests_go_to_the_postings(spark, rows, index, monkeypatch):
    """No shuffle of all postings for a handful of terms; the answers are those of the join by term."""
    terms = text_terms(spark.createDataFrame([(1, "w1 the"), (2, "w50 w3")], "key long, text string"))
    near = relevant(index, terms, FIELDS, 10, digits=6, grid=Grid(2, 2))
    with monkeypatch.context() as patch:
        patch.setattr(search, "join_by_term", None)
        relevant(index, terms, FIELDS, 10, digits=6)
    monkeypatch.setattr(search, "FEW_ROUTES", 0)
    assert lists(near) == lists(relevant(index, terms, FIELDS, 10, digits=6, grid=Grid(2, 2)))
