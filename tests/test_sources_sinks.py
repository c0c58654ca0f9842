from surveyprep.operators.reshape import drop_all_null, fill_missing, merge_alternates, wide_to_long
from surveyprep.session import shared_dir
from surveyprep.sinks.writers import read_staged, write_delimited
from surveyprep.sources.readers import PANDAS_NA_TOKENS, add_defaults, read_typed_csv, union_sources


def test_header_binding_and_na_tokens(spark):
    path = shared_dir(spark, "t_csv")
    spark.createDataFrame([("x", "NA", "3"), ("y", " ", "4"), ("z", "7", "")], "name string, code string, n string") \
        .select("n", "name", "code").write.option("header", True).option("ignoreLeadingWhiteSpace", False) \
        .option("ignoreTrailingWhiteSpace", False).csv(path)
    df = read_typed_csv(spark, path, ["name", "code", "n"], {"code": "Int8", "n": "Int16"},
                        na_tokens=list(PANDAS_NA_TOKENS) + [" "])
    assert sorted((tuple(r) for r in df.collect()), key=repr) == [("x", None, 3), ("y", None, 4), ("z", 7, None)]


def test_union_by_name_and_defaults(spark):
    a = spark.createDataFrame([(1, "m")], "k int, only_main string")
    b = add_defaults(spark.createDataFrame([(2,)], "k int"), {"src": 2}, {"k2": "k"})
    rows = sorted((r["k"], r["only_main"], r["src"], r["k2"]) for r in union_sources([a, b]).collect())
    assert rows == [(1, "m", None, None), (2, None, 2, 2)]


def test_pipe_roundtrip(spark):
    df = spark.createDataFrame([(1, "a|b", None), (2, "", "x")], "k int, t string, u string")
    path = write_delimited(df, shared_dir(spark, "t_pipe"))
    back = sorted((tuple(r) for r in read_staged(spark, path, df.schema).collect()), key=repr)
    # blank fields load as null: an empty text and a null are both blank in the hand-off
    assert back == [(1, "a|b", None), (2, None, "x")]


def test_wide_to_long_and_fill(spark):
    df = spark.createDataFrame([(1, 10, None, None, None), (2, None, None, 5, 6)], "h int, m_1 int, m_2 int, p_1 int, p_2 int")
    long = drop_all_null(wide_to_long(df, ["m", "p"], "h", "slot", [1, 2]), ["m", "p"])
    assert sorted((tuple(r) for r in long.collect()), key=repr) == [(1, 1, 10, None), (2, 1, None, 5), (2, 2, None, 6)]
    f = fill_missing(spark.createDataFrame([(None, 1)], "s string, n int"), "Missing")
    assert tuple(f.first()) == ("Missing", 1)


def test_merge_alternates(spark):
    df = spark.createDataFrame([("Yes", "No"), ("Missing", "No"), ("Not Applicable", "Missing"), ("Missing", None),
                                (None, "Yes")], "a string, b string")
    got = [r[0] for r in df.select(merge_alternates("a", "b")).collect()]
    assert got == ["Yes", "No", "Not Applicable", None, None]
