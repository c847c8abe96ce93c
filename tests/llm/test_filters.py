import random
import re
from pathlib import Path

import numpy as np
import pytest
from conftest import ordered, outcome
from pyspark.sql import functions as F

import brute
from shelfwise.llm import ngram_models
from shelfwise.llm.decontamination import find_contamination
from shelfwise.llm.mixing import MOST, SHARE, WEIGHTS, emit, mix
from shelfwise.llm.ordered import running_last, running_sums
from shelfwise.llm.quality_classifier import importance
from shelfwise.llm.quality_rules import apply_rules
from shelfwise.llm.url_filter import judge_urls
from shelfwise.session import scratch


@pytest.mark.parametrize("block", [1 << 17, 5])
def test_contamination(spark, odd, odd_rows, block):
    texts = dict(odd_rows)
    items = [
        (1, texts[7]), (2, texts[7]), (10, "ONE"), (None, texts[25][:300]), (3, None), (4, ""), (5, "never seen 漢 words"),
        (6, " ".join(texts[40].split()[70_000:70_030])), (7, " ".join(texts[71].split()[:2])),
    ]
    benchmark = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, n_hit string")
    found = find_contamination(odd, benchmark, block)
    expected = ordered([(d, n, h, len(i), c) for d, n, h, i, c in brute.contamination(odd_rows, items)])
    got = found.withColumn("n_items", F.size("items"))
    assert outcome(got, "doc_id", "n_words", "n_hit", "n_items", "contaminated") == expected
    names = {tuple(i) for _, _, _, i, _ in brute.contamination(odd_rows, items)}
    assert {tuple(r["items"]) for r in found.collect()} == names
    assert find_contamination(odd.where("false"), benchmark).count() == 0
    clean = find_contamination(odd, benchmark.where("false"))
    assert clean.where("contaminated OR n_hit > 0").count() == 0 and clean.count() == len(odd_rows)


def test_one_block_of_windows_at_a_time(spark, odd):
    items = [(k, f"one two three four five six seven eight nine ten eleven twelve {k} and more") for k in range(40)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    with scratch(spark) as folder:
        found = find_contamination(odd, benchmark, 20)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("MapInArrow") == 1
        local = Path(folder.removeprefix("file:"))
        assert len(list(local.glob("hits-*"))) == 1
        assert found.count() == odd.count() and found.where("n_hit > 0").count() == 0


def test_rules_count_like_brute_force(odd, odd_rows, labels):
    found = apply_rules(odd, labels)
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert outcome(found, "doc_id", *columns) == ordered([(d, *brute.rules(t)) for d, t in odd_rows])
    for row in found.collect():
        failed = row.n_words < 10 or 100 * row.n_repeat_words > 20 * row.n_words
        assert row.base_failed == failed and not (failed and row.kept)
    assert apply_rules(odd.where("false"), labels).count() == 0
    assert apply_rules(odd, labels.where("false")).where("kept = base_failed").count() == 0


def junk_and_prose(spark):
    rng = random.Random(3)
    names = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(200)]
    rows = []
    for k in range(400):
        text = " ".join(rng.choices(names, k=80))
        rows.append((k, re.sub(r"(\w+)", r"\1##$", text) if k % 4 == 0 else text))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs, docs.select("doc_id", (F.col("doc_id") % 4 > 0).cast("int").alias("quality"), F.lit(0).alias("toxic"))


def test_models_tell_junk_from_prose_on_held_out_documents(spark):
    docs, all_labels = junk_and_prose(spark)
    known = all_labels.where("doc_id < 200")
    kept = apply_rules(docs, known).where("doc_id >= 200").select("doc_id", "kept").collect()
    assert all(r.kept == (r.doc_id % 4 > 0) for r in kept) and len(kept) == 200
    chosen = importance(docs, known).where("doc_id >= 200").select("doc_id", "selected").collect()
    assert all(r.selected == (r.doc_id % 4 > 0) for r in chosen)


def test_importance_selects_as_many_as_asked(spark, odd, odd_rows, labels):
    docs, known = junk_and_prose(spark)
    first = importance(docs, known, size=100).where("selected").select("doc_id").collect()
    assert len(first) == 100 and first == importance(docs, known, size=100).where("selected").select("doc_id").collect()
    assert sum(r.doc_id % 4 == 0 for r in first) == 0
    assert importance(odd, labels).count() == len(odd_rows)
    assert importance(odd.where("false"), labels).count() == 0
    assert importance(odd, labels.where("false")).where("selected").count() == len(odd_rows)
    assert importance(odd, labels, size=0).where("selected").count() == 0


def test_length_does_not_decide_over_selection(spark):
    rng = random.Random(4)
    names = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(200)]
    seldom = ["".join(rng.choices("rstuvwxyz", k=5)) for _ in range(2000)]
    docs = [(k, " ".join(rng.choices(names, k=80))) for k in range(800)]
    # Long and a little worse than trusted text per n-gram: its sum lies below that of any short text.
    docs += [(1000, " ".join(rng.choice(seldom if rng.random() < 0.9 else names) for _ in range(8000)))]
    docs += [(2000 + k, " ".join(f"{w}#$" for w in rng.choices(seldom, k=16))) for k in range(50)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    known = table.where("doc_id < 700").select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    found = {r.doc_id: r for r in importance(table, known).collect()}
    assert found[1000].log_ratio < min(r.log_ratio for k, r in found.items() if k >= 2000)
    assert found[1000].selected and not any(r.selected for k, r in found.items() if k >= 2000)


def test_few_insults_convict_on_held_out_documents(spark):
    rng = random.Random(6)
    names = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(200)]
    rows = []
    for k in range(600):
        text = rng.choices(names, k=120)
        if k % 6 == 0:
            for at in rng.sample(range(120), 4):
                text[at] = rng.choice(["zounds", "knave", "varlet"])
        rows.append((k, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = docs.where("doc_id < 400").select("doc_id", F.lit(1).alias("quality"), (F.col("doc_id") % 6 == 0).cast("int").alias("toxic"))
    for found in (apply_rules(docs, known).select("doc_id", "kept"), importance(docs, known).select("doc_id", "selected")):
        rest = [tuple(r) for r in found.where("doc_id >= 400").collect()]
        assert len(rest) == 200 and not any(good for k, good in rest if k % 6 == 0)
        assert sum(good for _, good in rest) >= 0.96 * sum(k % 6 > 0 for k, _ in rest)


def test_limits_lose_few_good_ones():
    good, bad = np.arange(100.0), np.arange(-50.0, 50.0)
    limit = ngram_models.best_limit(good, bad, -7.0)
    assert (good < limit).mean() <= ngram_models.MOST_LOST and (bad < limit).mean() >= 0.5
    assert ngram_models.best_limit(good + 200, bad, -7.0) == 124.5
    assert ngram_models.best_limit(good, bad[:3], -7.0) == ngram_models.best_limit(good[:3], bad, -7.0) == -7.0


def test_limits_of_tables_are_those_of_arrays(spark):
    rng = np.random.default_rng(5)
    values = [("a", float(v), 1, 0) for v in np.round(rng.normal(1, 1, 400), 2)]
    values += [("a", float(v), 0, 1) for v in np.round(rng.normal(-1, 1, 300), 2)]
    values += [("b", float(v), 1, int(v > 7)) for v in range(9)]
    values += [("c", 0.5, 1, 1) for _ in range(20)]
    table = spark.createDataFrame(values, "name string, value double, good int, bad int")
    expected = {
        n: ngram_models.best_limit(
            np.array([v for m, v, g, _ in values if m == n and g]), np.array([v for m, v, _, b in values if m == n and b]), -7.0
        ) for n in "abcd"
    }
    assert ngram_models.best_limits(table, dict.fromkeys("abcd", -7.0)) == expected
    assert expected["a"] > -2 and expected["b"] == expected["d"] == -7.0 and expected["c"] == -0.5


def test_models_use_the_labels_of_any_number_of_documents(spark):
    """The labelled documents with texts come after 20,600 others in the order of their ids' hashes."""
    ids = spark.range(21_000).select(F.col("id").alias("doc_id")).orderBy(F.xxhash64("id")).toPandas()["doc_id"]
    last = spark.createDataFrame([(k, int(i)) for k, i in enumerate(ids[-400:])], "k long, id long")
    docs, labels = junk_and_prose(spark)
    docs, labels = (t.join(last, F.col("doc_id") == F.col("k")).drop("doc_id", "k").withColumnRenamed("id", "doc_id") for t in (docs, labels))
    rest = spark.createDataFrame([(int(i), 1, 0) for i in ids[:-400]], "doc_id long, quality int, toxic int")
    known = labels.select("doc_id", "quality", "toxic").unionByName(rest)
    kept = apply_rules(docs, known).join(labels, "doc_id").select("kept", "quality").collect()
    assert len(kept) == 400 and all(r.kept == (r.quality == 1) for r in kept)


def test_trusted_ids_are_bounded_and_unanimous(spark):
    rows = [(k, 1, 0) for k in range(50)] + [(3, 0, 0), (4, 1, 1), (5, 1, None), (None, 1, 0)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    assert set(ngram_models.trusted_ids(labels)) == set(range(50)) - {3, 4, 5}
    assert len(ngram_models.trusted_ids(labels, 10)) <= 10


def targets(sizes):
    """Shares by weight with limits, by repeated sharing."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: WEIGHTS[k % len(WEIGHTS)] for k, s in enumerate(names)}
    total, full = SHARE * sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in full]
        level = (total - sum(full.values())) / max(sum(weight[s] for s in open_), 1)
        above = [s for s in open_ if weight[s] * level > MOST * sizes[s]]
        if not above:
            return full | {s: weight[s] * level for s in open_}
        full |= {s: float(MOST * sizes[s]) for s in above}


def test_mixing(odd, odd_rows):
    rows = mix(odd).collect()
    assert len(rows) == len(odd_rows)
    assert sorted(r["size"] for r in rows) == sorted(len(brute.words(t)) for _, t in odd_rows)
    sizes, taken = {}, {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
        taken[r.source] = taken.get(r.source, 0) + r["size"] * r.copies
        assert 0 <= r.copies <= MOST
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets(sizes)[r.source])
        largest = max(x["size"] for x in rows if x.source == r.source)
        assert abs(taken[r.source] - r.target) <= largest
    assert outcome(mix(odd), "doc_id", "size", "copies") == outcome(mix(odd.repartition(3)), "doc_id", "size", "copies")
    assert emit(mix(odd)).count() == sum(r.copies for r in rows)
    assert set(emit(mix(odd)).columns) >= {"doc_id", "text", "lang", "copy"}
    assert mix(odd.where("false")).count() == 0
    assert mix(odd.withColumn("text", F.lit(None).cast("string"))).where("copies > 0").count() == 0


def test_running_values_cross_ranges(spark):
    df = spark.range(5000).select((F.col("id") % 3 == 0).cast("int").alias("g"), F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    got = {(r.g, r.k): r.total for r in running_sums(df, ["g"], ["k"], {"total": F.col("v")}).collect()}
    totals = {}
    for k in range(5000):
        g = int(k % 3 == 0)
        totals[g] = totals.get(g, 0) + k % 7
        assert got[g, k] == totals[g]
    marked = df.select("k", F.when(F.col("k") % 1999 == 5, F.col("k")).alias("mark"))
    for r in running_last(marked, ["k"], "mark", "last").collect():
        assert r["last"] == (None if r.k < 5 else 5 + 1999 * ((r.k - 5) // 1999))


def judged(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host, path = re.match(r"(?s)([^/?#]*)([^?#]*)", rest).groups()
        host = brute.lower(host)
    fits = [
        (len(h) + len(p), len(h), h + p, v)
        for v, h, p in ((v, h, p or "") for v, h, p in rules if h is not None)
        if f".{host}".endswith(f".{h}") and path.startswith(p)
    ]
    rule = max(fits, default=(0, 0, None, "allow"))
    return host, path, rule[2], rule[3]


def test_url_rules(spark):
    rng = random.Random(5)
    hosts = ["a.com", "b.a.com", "c.b.a.com", "xa.com", "com", "A.Com", "b.a.com:80", "", "é.fr", "a.com."]
    paths = ["", "/", "/x", "/x/", "/x/y/z", "/xy", "/X/", "/x?q=/x/", "#/x", "/é/ü"]
    urls = [f"{rng.choice(['http', 'https', ''])}://{rng.choice(hosts)}{rng.choice(paths)}" for _ in range(300)]
    urls += [None, "", "no scheme", "://", "http://a.com/x://b", "x" * 100_000, "http://" + "l." * 5000 + "a.com/x/y"]
    rules = [
        ("block", "com", ""), ("allow", "a.com", "/"), ("block", "a.com", "/x"), ("allow", "a.com", "/x/y/"),
        ("block", "b.a.com", "/xy"), ("allow", "fr", "/é"), ("block", "a.com", "/x"), ("allow", "a.com", "/x"),
        ("block", None, "/"), ("allow", "b.a.com", None),
    ]
    pages = spark.createDataFrame([(None if k == 3 else k // 2, u, "c") for k, u in enumerate(urls)], "page_id long, url string, host string")
    table = spark.createDataFrame(rules, "verdict string, host string, path string")
    found = judge_urls(pages.repartition(4), table)
    one = [r for r in rules if r != ("allow", "a.com", "/x")]
    expected = [(None if k == 3 else k // 2, u, *judged(u, one)) for k, u in enumerate(urls)]
    assert outcome(found, "page_id", "url", "host", "path", "rule", "verdict") == ordered(expected)
    assert judge_urls(pages.where("false"), table).count() == 0
    assert judge_urls(pages, table.where("false")).where("verdict = 'allow' AND rule IS NULL").count() == len(urls)
