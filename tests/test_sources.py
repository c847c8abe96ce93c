import json
from pathlib import Path

from pyspark.sql import functions as F

from shelfwise.session import scratch, scratch_path, staged
from shelfwise.sources import raw, requests, tables
from workload import inputs


def test_compaction_gathers_the_lines_of_each_directory(spark, tmp_path):
    for category, files in {"books & more": 3, "toys+games": 2, "plain": 1, "007": 1}.items():
        folder = tmp_path / "in" / category
        folder.mkdir(parents=True)
        for i in range(files):
            (folder / f"{i}.json").write_text("".join(f'{{"n": {i}{j}}}\n' for j in range(4)))
        (folder / "notes.txt").write_text("not json\n")
    target = str(tmp_path / "out")
    raw.compact_small_files(spark, str(tmp_path / "in"), target)
    counts = {r[0]: r[1] for r in spark.read.text(target).groupBy("category").count().collect()}
    assert counts == {"books & more.json": 12, "toys+games.json": 8, "plain.json": 4, "007.json": 4}
    assert raw.read_raw(spark, target).count() == 28
    assert len(list((tmp_path / "in" / "plain").glob("*.json"))) == 1


def test_a_large_directory_becomes_several_files(spark, tmp_path):
    for category, files in {"large": 20, "small": 1}.items():
        folder = tmp_path / "in" / category
        folder.mkdir(parents=True)
        for i in range(files):
            (folder / f"{i}.json").write_text("".join(f'{{"n": "{i}-{j}"}}\n' for j in range(2000)))
    target = str(tmp_path / "out")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100k")
    try:
        raw.compact_small_files(spark, str(tmp_path / "in"), target)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    read = spark.read.text(target).select("category", F.input_file_name().alias("file"))
    lines = read.groupBy("category").agg(F.count("*"), F.count_distinct("file"))
    counts = {r[0]: (r[1], r[2]) for r in lines.collect()}
    assert counts["small.json"] == (2000, 1)
    assert counts["large.json"][0] == 40_000 and 1 < counts["large.json"][1] < 20


def test_compressed_files_are_compacted_and_results_are_compressed(spark, tmp_path):
    lines = spark.range(20_000).selectExpr("CAST(id % 2 AS STRING) AS category", "concat('{\"n\": ', id, '}') AS value")
    lines.write.partitionBy("category").option("compression", "gzip").text(str(tmp_path / "text"))
    for folder in (tmp_path / "text").glob("category=*"):
        (tmp_path / "in" / folder.name).mkdir(parents=True)
        for file in folder.glob("part-*"):
            (tmp_path / "in" / folder.name / f"{file.name.split('.')[0]}.json.gz").write_bytes(file.read_bytes())
    (tmp_path / "in" / "category=1" / "plain.json").write_text('{"n": -1}\n')
    target = tmp_path / "out"
    raw.compact_small_files(spark, str(tmp_path / "in"), str(target))
    counts = {r[0]: r[1] for r in spark.read.text(str(target)).groupBy("category").count().collect()}
    assert counts == {"category=0.json": 10_000, "category=1.json": 10_001}
    assert raw.read_raw(spark, str(target)).count() == 20_001
    assert sum(f.stat().st_size for f in target.rglob("part-*")) < 20_001 * 11 / 2


def test_raw_files_may_be_compressed(spark, tmp_path):
    documents = spark.range(50).select(F.struct(F.col("id").cast("string").alias("ProductID")).alias("ProductInfo"))
    documents.write.json(str(tmp_path / "raw"), compression="gzip")
    (tmp_path / "raw" / "plain.json").write_text(json.dumps({"ProductInfo": {"ProductID": "50"}}))
    (tmp_path / "raw" / "notes.txt").write_text("{}")
    found = raw.read_raw(spark, str(tmp_path / "raw")).select("ProductInfo.ProductID").collect()
    assert sorted(int(r[0]) for r in found) == list(range(51))


def test_gathered_documents_travel_no_more(spark, tmp_path):
    """Lines and products meet where the lines are gathered, so that only slim rows are shuffled."""
    lines = [(o, p, n, 10.0 * n, "A", "F") for o in (1, 10_001, 20_001) for p in (1, 2) for n in (1, 7)]
    dated = spark.createDataFrame(
        lines, "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_returnflag string, l_linestatus string"
    ).withColumn("l_shipdate", F.lit("2010-02-03").cast("date"))
    made = {
        "lineitem": dated,
        "orders": spark.createDataFrame([(o, 5) for o in (1, 10_001, 20_001)], "o_orderkey long, o_custkey long"),
        "customer": spark.createDataFrame([(5, "Ann")], "c_custkey long, c_name string"),
        "part": spark.createDataFrame(
            [(k, "n", "b", "t", 1, 2.5) for k in (1, 2, 3)],
            "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
        ),
    }
    for name, table in made.items():
        table.write.parquet(f"{tmp_path}/{name}.parquet")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        documents = inputs.raw_documents(spark, str(tmp_path))
        plan = documents._jdf.queryExecution().executedPlan().toString()
        found = documents.select("ProductInfo.ProductID", F.size("Reviews").alias("n")).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.split("collect_list")[0].count("Exchange hashpartitioning(") == 1
    assert sorted((r.ProductID, r.n) for r in found) == [("P1", 2)] * 3 + [("P2", 2)] * 3 + [("P3", None)]


def test_one_named_file(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.json").write_text(json.dumps({"ProductInfo": {"ProductID": name}}))
    (tmp_path / "c.txt").write_text("{}")
    assert raw.read_raw(spark, str(tmp_path)).count() == 2
    assert raw.read_raw(spark, str(tmp_path), "b.json").first()["ProductInfo"]["ProductID"] == "b"


def test_tables_are_replaced_and_laid_out_by_key(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(1000).select((1000 - F.col("id")).cast("int").alias("id"), F.lit("x").alias("v"))
    tables.write_table(df, path, "id")
    assert len(list(Path(path).glob("_bucket=*"))) == 1
    tables.write_table(df, path, "id", folders=64)
    assert len(list(Path(path).glob("_bucket=*"))) == 64
    back = tables.read_table(spark, path, keyed=True)
    assert back.count() == 1000 and tables.read_table(spark, path).columns == df.columns
    assert back.where(F.col(tables.BUCKET) != tables.bucket_of("id", 64)).count() == 0
    rows = back.select(F.input_file_name().alias("f"), "id").collect()
    for file in {r.f for r in rows}:
        found = [r.id for r in rows if r.f == file]
        assert found == sorted(found)


def test_folders_follow_the_size():
    sizes = [0, 1, 16 << 20, (16 << 20) + 1, 100 << 20, 1 << 40, 1 << 60]
    assert [tables.folders_for(s) for s in sizes] == [1, 1, 1, 2, 8, 8192, 8192]


def test_a_hot_key_spreads_over_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20k")
    try:
        df = spark.range(20_000).select(F.lit(1).alias("id"), F.col("id").alias("v"))
        tables.write_table(df, path, "id")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    back = tables.read_table(spark, path)
    assert back.count() == 20_000
    assert back.select(F.input_file_name()).distinct().count() > 2


def test_requests_and_answers(spark, tmp_path):
    asked = tmp_path / "asked.json"
    asked.write_text('{"productId": 1}\n{"productId": 2}\n{"productId": 2}\n')
    wanted = requests.read_requests(spark, str(asked), "product")
    assert wanted.count() == 3
    found = spark.createDataFrame(
        [(2, 1, 5, 0.5), (2, 2, None, None)], "productId int, rank int, pid int, rating double"
    )
    nested = requests.nest_answers(wanted, found, "productId", ["pid", "rating"])
    out = str(tmp_path / "answers")
    requests.write_answers(nested, out)
    lines = sorted(r[0] for r in spark.read.text(out).collect())
    assert [json.loads(line) for line in lines] == [
        {"productId": 1, "items": []},
        {"productId": 2, "items": [{"pid": 5, "rating": 0.5}, {"pid": None, "rating": None}]},
    ]


def test_staged_tables_stand_alone(spark):
    first, second = (staged(spark.range(5), "numbers") for _ in range(2))
    assert first.inputFiles() != second.inputFiles() and first.count() == 5
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_a_scratch_scope_leaves_nothing(spark):
    with scratch(spark) as folder:
        inner = staged(spark.range(5), "numbers")
        with scratch(spark) as nested:
            assert nested.startswith(folder)
            staged(spark.range(5), "numbers")
        assert not Path(nested).exists() and inner.count() == 5
    assert not Path(folder).exists()
    assert not scratch_path(spark, "x").startswith(folder)


def test_a_second_key_skips_row_groups(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(50_000).select("id", F.concat(F.lit("name"), F.col("id") * 7919 % 50_000).alias("extId"))
    tables.write_table(df, path, "id", also=("extId",), folders=64)
    found = tables.read_table(spark, path).where("extId = 'name77'")
    assert found.count() == 1
    assert rows_scanned(found) <= 50_000 // 8
    plain = tables.read_table(spark, path).where("extId LIKE '%77777'")
    assert rows_scanned(plain) == 50_000


def rows_scanned(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))
