from surveyprep.functions import predicates as P


def test_null_safe_predicates(spark):
    df = spark.createDataFrame([("F", 1), (None, None), ("O", 5)], "s string, n int")
    rows = df.select(P.eq("s", "F"), P.ne("s", "F"), P.is_in("s", ["F", "O"]), P.not_in("s", ["F"]),
                     P.gt("n", 0), P.ge("n", 5), P.le("n", 1), P.lt("n", 2)).collect()
    assert [tuple(r) for r in rows] == [
        (True, False, True, False, True, False, True, True),
        (False, True, False, True, False, False, False, False),
        (False, True, True, True, True, True, False, False),
    ]


def test_none_in_ignores_null_slots(spark):
    df = spark.createDataFrame([(1, None, None, None), (None, None, None, 2), (None, None, None, None), (7, 8, 9, 7)],
                               "a int, b int, c int, d int")
    got = [r[0] for r in df.select(P.none_in(["a", "b", "c", "d"], [1, 2])).collect()]
    assert got == [False, False, True, True]
