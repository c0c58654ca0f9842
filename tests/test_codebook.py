from surveyprep.operators.codebook import Codebook, field_map, load_codebook, map_expr, topcode_map

DATASETS = ["border_trips", "day", "households", "intercept", "persons", "trips", "vehicles"]


def test_codebook_inventory():
    books = {d: load_codebook(d) for d in DATASETS}
    assert sum(len(b.fields) for b in books.values()) == 213
    assert sum(b.n_codes for b in books.values()) == 1413


def test_listed_unlisted_null(spark):
    fm = field_map([(1, "One"), (2, "Two")], null_label="Missing")
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "c int")
    got = [r[0] for r in df.select(map_expr("c", fm)).collect()]
    assert got == ["One", "Two", None, "Missing"]


def test_no_null_label_keeps_null(spark):
    fm = field_map([(1, "One")])
    df = spark.createDataFrame([(None,), (1,)], "c int")
    assert [r[0] for r in df.select(map_expr("c", fm)).collect()] == [None, "One"]


def test_topcode_and_mixed_labels(spark):
    fm = topcode_map(0, 12, null_label="Missing")
    df = spark.createDataFrame([(0,), (11,), (12,), (13,), (None,)], "c int")
    assert [r[0] for r in df.select(map_expr("c", fm)).collect()] == ["0", "11", "12+", None, "Missing"]
    mixed = field_map([(0, 0), (1, 1), (7, "7+")])
    assert [lab for _, lab in mixed.codes] == ["0", "1", "7+"]


def test_text_keys_and_quotes(spark):
    fm = field_map([("it's", "Quote's"), ("b", "B")])
    df = spark.createDataFrame([("it's",), ("x",)], "c string")
    assert [r[0] for r in df.select(map_expr("c", fm)).collect()] == ["Quote's", None]
    assert [r[0] for r in df.select(map_expr(df["c"], fm)).collect()] == ["Quote's", None]


def test_category_order():
    cb = load_codebook("day")
    assert cb["travel_dow"].categories()[0] == "Monday"
    assert cb["travel_dow"].categories()[-1] == "Missing"
    assert isinstance(cb, Codebook)
