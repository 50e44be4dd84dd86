"""Text files in and out: order, numbering, odd records, pruned splits."""

import pytest
from pyspark.sql import functions as F

from lotwise.operators import ranking, split
from lotwise.sources import readers, writers


def test_lines_keep_their_order(spark, tmp_path):
    rows = spark.range(1000).select(
        F.format_string("%03d", F.col("id") % 7).alias("part"), (-F.col("id")).alias("place"),
        writers.csv_line(F.col("id").cast("string"), F.when(F.col("id") % 5 == 0, 'a "b", c\nd'), F.lit("")).alias("line"))
    path = str(tmp_path / "lines")
    writers.write_lines(rows.repartition(9), path, "id,text,none", "part", ["place"])
    files = sorted((tmp_path / "lines").glob("part=*/part-*"))
    assert len(files) == 7 and all(f.read_text().startswith("id,text,none\n") for f in files)
    read = readers.read_text_csv(spark, f"{path}/part=*", multi_line=True)
    got = read.orderBy(*ranking.FILE_ORDER).collect()
    expected = [i for p in range(7) for i in sorted(range(p, 1000, 7), reverse=True)]
    assert [int(r["id"]) for r in got] == expected
    assert all(r["text"] == ('a "b", c\nd' if int(r["id"]) % 5 == 0 else None) for r in got)
    first = readers.read_text_csv(spark, f"{path}/part=*", nrows=20, multi_line=True).collect()
    assert sorted(int(r["id"]) for r in first) == sorted(expected[:20])
    numbered = readers.load_listings(spark, f"{path}/part=*", multi_line=True).collect()
    assert [int(r["id"]) for r in sorted(numbered, key=lambda r: r["row"])] == expected
    assert sorted(r["row"] for r in numbered) == list(range(2, 1002))


def test_line_numbers_over_splits(spark, tmp_path):
    """Blocks of one large file and several files, numbered without a sort of the rows."""
    for name, n in (("b.csv", 3000), ("a.csv", 10), ("c.csv", 1)):
        (tmp_path / name).write_text("v,w\n" + "".join(f"{name}{i},{'x' * (i % 50)}\n" for i in range(n)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        rows = readers.load_listings(spark, str(tmp_path))
        got = {r["v"]: r["row"] for r in rows.collect()}
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert rows.rdd.getNumPartitions() > 10
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    names = [f"{f}{i}" for f, n in (("a.csv", 10), ("b.csv", 3000), ("c.csv", 1)) for i in range(n)]
    assert got == {v: i + 2 for i, v in enumerate(names)}
    assert "rangepartitioning" not in plan.lower()


def test_long_and_short_records(spark, tmp_path):
    path = tmp_path / "odd.csv"
    path.write_text('a,b,c\n1,2,3\n1,2,3,4\n"x, y",NA\n\n"m\nn","o ""p""",q\n"1","2,2","3",,\n')
    rows = readers.read_text_csv(spark, str(path), multi_line=True).collect()
    assert sorted([(r["a"], r["b"], r["c"]) for r in rows], key=str) == sorted(
        [("1", "2", "3"), ("x, y", None, None), ("m\nn", 'o "p"', "q")], key=str)
    kept = readers.read_text_csv(spark, str(path), multi_line=True, skip_long_rows=False).count()
    assert kept == 5


def test_split_folder_is_pruned(spark, tmp_path):
    tagged = split.with_split(spark.range(2000).withColumn("x", F.col("id") * 2), ["id"])
    path = str(tmp_path / "splits")
    writers.write_splits(tagged, path)
    for name in ("train", "val", "test"):
        back = writers.read_split(spark, path, tagged.schema, name)
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, tagged.where(F.col("split") == name).collect()))
        plan = back._jdf.queryExecution().executedPlan().toString()
        assert f"PartitionFilters: [isnotnull(split" in plan and f"= {name})" in plan


@pytest.mark.parametrize("width", [1, 10, 100_000])
def test_key_rank(spark, width):
    keys = [None, None, -5, -5, -5, 0, 7, 7, 999, 1_000_000_000_000, 3, 3, 3, 3]
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k long, i long").repartition(4)
    got = ranking.with_key_rank(df, "k", ["k", "i"], "row", start=2, width=width)
    order = sorted(range(len(keys)), key=lambda i: (keys[i] is not None, keys[i] or 0, i))
    assert [r["i"] for r in sorted(got.collect(), key=lambda r: r["row"])] == order
    assert sorted(r["row"] for r in got.collect()) == list(range(2, len(keys) + 2))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan.lower()
    assert ranking.with_key_rank(df.limit(0), "k", ["k", "i"]).count() == 0
