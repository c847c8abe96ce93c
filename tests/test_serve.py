import json

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import recs
from shelfwise.plans import recommend
from shelfwise.plans.serve import answer_files

LISTS = "id int, recs array<struct<pid:int,r:double>>"


@pytest.fixture(scope="module")
def stored(spark):
    return spark.createDataFrame([(i, [(i + k, 1.0 - k / 10) for k in range(1, 4)]) for i in range(50)], LISTS)


def put(folder, name, ids):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps({"productId": i}) + "\n" for i in ids))


def answers(spark, path):
    schema = "file string, productId int, items array<struct<productId:int,rating:double>>"
    return sorted(
        (r.file, r.productId, [x.productId for x in r["items"]]) for r in spark.read.schema(schema).json(f"{path}/batch=*").collect()
    )


def run(spark, folder, stored, files_per_batch=100, answer=None):
    return answer_files(
        spark, "product", str(folder / "in"), str(folder / "out"), str(folder / "done"),
        answer or (lambda q: recommend.by_product(q, stored)), "requestId", ["productId", "rating"], files_per_batch,
    )


def test_each_file_is_answered_once_over_restarts(spark, stored, tmp_path):
    put(tmp_path / "in", "a.json", [1, 2, 2, 99])
    put(tmp_path / "in", "b.json", [2])
    assert run(spark, tmp_path, stored, files_per_batch=1) == 5
    assert run(spark, tmp_path, stored) == 0
    put(tmp_path / "in", "c.json", [3])
    assert run(spark, tmp_path, stored) == 1
    two = [3, 4, 5]
    assert answers(spark, tmp_path / "out") == [
        ("a.json", 1, [2, 3, 4]), ("a.json", 2, two), ("a.json", 2, two), ("a.json", 99, []),
        ("b.json", 2, two), ("c.json", 3, [4, 5, 6]),
    ]


def test_a_batch_that_was_cut_off_is_answered_again(spark, stored, tmp_path):
    put(tmp_path / "in", "a.json", [1])
    calls = []

    def failing(q):
        calls.append(1)
        # What a lost run may leave behind under the number of its batch.
        put(tmp_path / "out", "left.json", [7])
        (tmp_path / "out" / "batch=0").mkdir()
        (tmp_path / "out" / "left.json").rename(tmp_path / "out" / "batch=0" / "part-0.json")
        raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        run(spark, tmp_path, stored, answer=failing)
    assert run(spark, tmp_path, stored) == 1 and calls == [1]
    assert answers(spark, tmp_path / "out") == [("a.json", 1, [2, 3, 4])]


def test_one_id_asked_by_half_of_all_requests(spark, stored, monkeypatch):
    monkeypatch.setattr(recs, "TIMES_PER_ROW", 100)
    ids = F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 50).cast("int").alias("productId")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for columns in ([ids], [ids, F.col("id").alias("ticket")]):  # equal requests, and requests that differ
            asked = spark.range(40_000).select(*columns)
            found = recommend.by_product(asked, stored)
            assert found.count() == 3 * 40_000
            per_id = {r[0]: r[1] for r in found.groupBy("requestId").count().collect()}
            assert per_id[7] == 3 * 20_800 and per_id[1] == 3 * 800
            sizes = [r[1] for r in found.groupBy(F.spark_partition_id()).count().collect()]
            assert max(sizes) <= 2.5 * 3 * 40_000 / 8
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_null_and_unknown_keys_have_no_answers(spark, stored):
    asked = spark.createDataFrame([(None, "x"), (99, "y"), (1, None), (1, None)], "productId int, note string")
    found = recommend.by_product(asked, stored)
    assert found.columns == ["requestId", "note", "rank", "productId", "rating"]
    assert sorted((r.requestId, r.note, r["rank"]) for r in found.collect()) == [(1, None, k) for k in (1, 1, 2, 2, 3, 3)]
    assert recommend.by_product(asked.where("false"), stored).count() == 0
