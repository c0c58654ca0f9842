import random

from pyspark.sql import functions as F

from surveyprep.operators.keys import add_sentinel, dense_key, load_order_key, natural_key, row_key


def _frame(spark, n=500, seed=3):
    rnd = random.Random(seed)
    rows = [(rnd.randint(0, 40), rnd.choice([1, 2, 3, None]), i) for i in range(n)]
    return spark.createDataFrame(rows, "a int, b int, id int")


def test_row_key_ranged_equals_window(spark):
    df = _frame(spark)
    for parts in (1, 3, 7):
        r = {x["id"]: x["k"] for x in row_key(df, ["a", "b", "id"], "k", num_partitions=parts).collect()}
        w = {x["id"]: x["k"] for x in row_key(df, ["a", "b", "id"], "k", method="window").collect()}
        assert r == w
        assert sorted(r.values()) == list(range(len(r)))


def test_dense_key_ranged_equals_window_and_null_zero(spark):
    df = _frame(spark)
    r = {x["id"]: x["k"] for x in dense_key(df, ["a", "b"], "k", num_partitions=5).collect()}
    w = {x["id"]: x["k"] for x in dense_key(df, ["a", "b"], "k", method="window").collect()}
    assert r == w
    nulls = df.where(F.col("b").isNull()).select("id").collect()
    assert all(r[x["id"]] == 0 for x in nulls)
    assert 0 not in {r[i] for i in r if i not in {x["id"] for x in nulls}}


def test_natural_key_unique_keys(spark):
    df = spark.createDataFrame([(i % 7, i // 7, i) for i in range(50)], "p int, d int, id int")
    got = {x["id"]: x["k"] for x in natural_key(df, ["p", "d"], "k").collect()}
    exp = {x["id"]: x["k"] for x in row_key(df, ["p", "d"], "k", method="window").collect()}
    assert got == exp


def test_sentinel(spark):
    df = spark.createDataFrame([(1, "x")], "k int, v string")
    out = add_sentinel(df, {"k": 0, "v": "Not Applicable"}).orderBy("k").collect()
    assert [tuple(r) for r in out] == [(0, "Not Applicable"), (1, "x")]


def test_dense_keys_that_span_ranges(spark):
    rnd = random.Random(8)
    # a third of the rows share one key, some are equal in all columns, keys have nulls, NaN and both zeros
    rows = [("hot", 1.0, i % 90) for i in range(300)] + [(rnd.choice(["a", "b", "é", None, "zz"]), rnd.choice([0.0, -0.0, float("nan"), 2.5, None]), i) for i in range(600)]
    df = spark.createDataFrame(rows, "k string, f double, id int")
    for parts in (1, 4, 40):
        got = dense_key(df, ["k", "f"], "n", num_partitions=parts)
        want = dense_key(df, ["k", "f"], "n", method="window")
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert dense_key(df.limit(0), "k", "n").count() == 0
    assert {r["n"] for r in dense_key(df.where("k is null"), "k", "n").collect()} == {0}


def test_dense_key_has_one_range_exchange(spark):
    df, seen = _frame(spark), []
    real = type(df).checkpoint
    try:
        type(df).checkpoint = lambda self, *a, **b: seen.append(self._jdf.queryExecution().executedPlan().toString()) or real(self, *a, **b)
        out = dense_key(df, ["a", "b"], "n")
    finally:
        type(df).checkpoint = real
    rest = out._jdf.queryExecution().executedPlan().toString()
    assert len(seen) == 1 and seen[0].count("Exchange rangepartitioning") == 1 and seen[0].count("Exchange") == 1
    assert "rangepartitioning" not in rest and "SortMergeJoin" not in rest


def test_load_order_over_files_and_blocks(spark, tmp_path):
    for n, rows in (("b", 4000), ("a", 3000), ("c", 10)):
        (tmp_path / n).mkdir()
        for part in range(3):
            (tmp_path / n / f"part-{part}.csv").write_text("id,v\n" + "".join(f"{n}{part}-{i},{'x' * (i % 30)}\n" for i in range(rows - part)))
    want = [f"{n}{part}-{i}" for n, rows in (("b", 4000), ("a", 3000), ("c", 10)) for part in range(3) for i in range(rows - part)]
    small = {"spark.sql.files.maxPartitionBytes": "20000", "spark.sql.files.openCostInBytes": "1000"}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        csv = [spark.read.option("header", True).csv(str(tmp_path / n)) for n in "bac"]
        assert csv[0].rdd.getNumPartitions() > 6
        got = sorted((r["n"], r["id"]) for r in load_order_key(csv, "n").collect())
        assert got == list(enumerate(want))
        for i, n in enumerate("bac"):
            csv[i].coalesce(1).write.option("parquet.block.size", 4096).parquet(str(tmp_path / f"p{n}"))
        kept = [r["id"] for n in "bac" for r in spark.read.parquet(str(tmp_path / f"p{n}")).select("id", "_metadata.row_index").orderBy("row_index").collect()]
        parquet = [spark.read.parquet(str(tmp_path / f"p{n}")) for n in "bac"]
        got = sorted((r["n"], r["id"]) for r in load_order_key([parquet[0], parquet[1].drop("v"), parquet[2]], "n", start=1).collect())
        assert got == list(enumerate(kept, 1))
    finally:
        for k in small:
            spark.conf.unset(k)
