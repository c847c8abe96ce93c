import re
from collections import Counter, defaultdict

import brute
import corpus_pipeline
from shelfwise.llm.mixing import offset
from shelfwise.llm.quality_classifier import importance
from test_filters import targets

FOLDER = "/root/testdata/sf0.001"


def rows_of(df):
    return [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]


def test_stages_beside_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    chosen = rows_of(importance(docs, labels).where("selected"))
    deduped = [(d, t, *chosen[k][2:4], len(t)) for k, (d, _, _, t) in enumerate(brute.lines([c[:2] for c in chosen]))]
    least = brute.groups([(r[0], brute.fingerprint(r[1])) for r in deduped])
    single = [r for r, g in zip(deduped, least) if r[0] == g]
    clean = [r for r, c in zip(single, brute.contamination([s[:2] for s in single], items)) if not c[4]]
    sizes, by_source = defaultdict(int), defaultdict(list)
    for r in clean:
        sizes[r[3]] += len(brute.words(r[1]))
        by_source[r[3]].append(r)
    expected = Counter()
    for source, rows in by_source.items():
        rate = targets(sizes)[source] / sizes[source] if sizes[source] else 0
        for k, r in enumerate(sorted(rows, key=lambda r: (len(brute.words(r[1])), r[0]))):
            expected[r] += int((k + 1) * rate + offset()) - int(k * rate + offset())
    found = corpus_pipeline.run(spark, FOLDER)
    assert Counter(rows_of(found)) == +expected


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    none = docs.where("false")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert re.fullmatch("[a-z ]+", name)
        kept = stage(spark, docs, FOLDER)
        assert kept.columns == docs.columns and [f.dataType for f in kept.schema] == [f.dataType for f in docs.schema]
        assert stage(spark, none, FOLDER).count() == 0
