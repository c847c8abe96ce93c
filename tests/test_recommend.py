from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import recs
from shelfwise.operators.text_index import build_index
from shelfwise.plans import recommend
from shelfwise.sources.tables import of_keys, read_table, write_table

LISTS = "id int, recs array<struct<pid:int,r:double>>"


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


@pytest.fixture(scope="module")
def stored(spark):
    data = [
        (1, [(5, 0.25), (4, 0.5), (3, 0.5)]),
        (2, [(None, 0.75), (9, None)]),
        (3, []),
        (4, None),
        (5, [(i, float(i)) for i in range(1, 15)]),
    ]
    return spark.createDataFrame(data, LISTS)


def test_lookup(spark, stored):
    wanted = spark.createDataFrame([(i,) for i in (1, 2, 3, 4, 77)], "productId int")
    got = rows(recommend.by_product(wanted, stored), "requestId", "rank", "productId", "rating")
    assert got == [(1, 1, 3, 0.5), (1, 2, 4, 0.5), (1, 3, 5, 0.25), (2, 1, 0, 0.75), (2, 2, 9, 0.0)]


def test_answers_have_ten_items(spark, stored):
    wanted = spark.createDataFrame([(5,)], "userId int")
    got = rows(recommend.by_user(wanted, stored), "rank", "productId")
    assert got == [(i, 15 - i) for i in range(1, 11)]


def test_a_request_asked_often_is_answered_each_time(spark, stored):
    wanted = spark.range(300).select(F.lit(5).alias("userId"), F.col("id").alias("ticket"))
    got = recommend.by_user(wanted, stored)
    assert got.count() == 3000 and got.select("ticket").distinct().count() == 300


def files_read(df, path):
    """How many files of the table at ``path`` the scans of a finished query opened."""
    df.collect()
    plans, files = [df._jdf.queryExecution().executedPlan()], 0
    while plans:
        plan = plans.pop()
        name = plan.nodeName()
        if name == "AdaptiveSparkPlan":
            plans.append(plan.executedPlan())
        elif "QueryStage" in name:
            plans.append(plan.plan())
        elif name.startswith("Scan parquet") and path in plan.relation().location().rootPaths().toString():
            files += plan.metrics().apply("numFiles").value()
        children = plan.children()
        plans += [children.apply(i) for i in range(children.size())]
    return files


@pytest.mark.parametrize("folders", [1, 64, 256])
def test_lookups_read_the_folders_of_their_keys(spark, tmp_path, folders):
    path = str(tmp_path / "recs")
    rows = 400 * folders
    lists = spark.range(rows).select(
        F.col("id").cast("int"), F.expr("array(struct(cast(id + 1 as int) as pid, 0.5D as r))").alias("recs")
    )
    write_table(lists, path, "id", folders=folders)
    table = read_table(spark, path, keyed=True)
    everything = len(table.inputFiles())
    assert everything == folders
    for n in (0, 1, 10, 100, 1001, 100_000):
        wanted = spark.range(n).select(F.col("id").cast("int").alias("userId"))
        answers = recommend.by_user(wanted, table)
        read = files_read(answers, path)
        assert answers.count() == min(n, rows)
        assert read <= min(n, everything)
        # A hundred keys fall into about folders * (1 - exp(-100 / folders)) of the folders.
        assert n != 100 or folders < 256 or read <= 0.45 * folders


def test_one_source_document_reads_few_files(spark, tmp_path):
    text = [(i, f"name{i}", f"red red shoe shoe number{i} number{i}") for i in range(2000)]
    index = build_index(spark.createDataFrame(text, "id int, name string, features string"))
    write_table(index.forward, str(tmp_path / "forward"), "id", folders=64)
    index = replace(index, forward=read_table(spark, str(tmp_path / "forward"), keyed=True))
    wanted = spark.createDataFrame([(5,)], "productId int")
    forward = len(index.forward.inputFiles())
    assert forward >= 50
    assert files_read(of_keys(index.forward, wanted), "forward") <= forward // 20
    assert recommend.similar_content(wanted, index).count() == 10


def test_many_long_requests_stay_in_bounds(spark):
    words = [f"w{i}" for i in range(3000)]
    docs = [(i, "n", " ".join(words[i % 50 :: 50])) for i in range(300)]
    index = build_index(spark.createDataFrame(docs, "id int, name string, features string"))
    asked = spark.range(600).select(F.col("id").alias("key"), F.lit(" ".join(words)).alias("text"))
    assert recommend.by_text(asked, index).count() == 6000


def ranked_list(spark, data):
    return spark.createDataFrame(data, "requestId int, rank int, productId int, rating double")


def test_blend_keeps_both_rows_of_a_product_and_the_cf_one_first(spark):
    collaborative = ranked_list(spark, [(1, 1, 7, 0.5), (1, 2, 8, 0.25)])
    content = ranked_list(spark, [(1, 1, 7, 2.0), (1, 2, 9, 1.0)])
    blended = recs.blend(collaborative, content, "requestId", cf_weight=0.5)
    got = rows(recs.best_blended(blended, "requestId", 3), "rank", "productId", "originalRating", "hybridRating")
    assert got == [(1, 7, 2.0, 1.0), (2, 9, 1.0, 0.5), (3, 7, 0.5, 0.25)]
    tied = recs.blend(collaborative, ranked_list(spark, [(1, 1, 3, 0.5)]), "requestId", cf_weight=0.5)
    got = rows(recs.best_blended(tied, "requestId"), "rank", "productId")
    assert got == [(1, 7), (2, 3), (3, 8)]


def test_hybrid_with_one_side_empty(spark, stored):
    text = [(i, "n", f"red red shoe shoe number{i}") for i in range(10, 20)]
    index = build_index(spark.createDataFrame(text, "id int, name string, features string"))
    wanted = spark.createDataFrame([(1,), (10,), (77,)], "productId int")
    got = recommend.hybrid(wanted, stored, index)
    by_request = {k: got.where(f"requestId = {k}").count() for k in (1, 10, 77)}
    assert by_request == {1: 3, 10: 9, 77: 0}
    first = got.where("requestId = 1 AND rank = 1").first()
    assert (first["productId"], first["originalRating"], first["hybridRating"]) == (3, 0.5, 0.4)


def test_content_requests_may_repeat(spark):
    text = [(i, "n", f"red red shoe shoe number{i}") for i in range(10, 20)]
    index = build_index(spark.createDataFrame(text, "id int, name string, features string"))
    wanted = spark.createDataFrame([(10, "a"), (10, "b")], "productId int, ticket string")
    assert recommend.similar_content(wanted, index, 4).count() == 8
