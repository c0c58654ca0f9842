"""Inputs that once changed or lost data: quoted cells, whole numbers, staged text, wide integers, unlisted codes, equal keys."""

import pytest
from pyspark.sql import functions as F

from surveyprep.operators.codebook import field_map, map_expr
from surveyprep.operators.contract import ColumnSpec, store_assign
from surveyprep.operators.keys import natural_key
from surveyprep.session import ensure_checkpoint_dir
from surveyprep.sinks.writers import read_staged, write_delimited
from surveyprep.sources.readers import read_text_csv, read_typed_csv, rejected_cells


def test_quoted_cells(spark, tmp_path):
    p = tmp_path / "a.csv"
    p.write_text('id,t,n\n1,"he said ""hi"", ok",1.0\n2,"two\nlines",7\n3,x,bad\n4,y,2.5\n5,z,NA\n')
    got = read_typed_csv(spark, str(p), ["n", "t", "id"], {"id": "int", "n": "Int8"}, multi_line=True).collect()
    assert [tuple(r) for r in got] == [(1, 'he said "hi", ok', 1), (7, "two\nlines", 2), (None, "x", 3), (None, "y", 4), (None, "z", 5)]
    bad = rejected_cells(read_text_csv(spark, str(p), multi_line=True), ["id", "n"], {"id": "int", "n": "Int8"}).collect()
    assert {r.field: r.rejected for r in bad} == {"id": 0, "n": 2}


def test_staged_text_is_exact(spark, tmp_path):
    rows = [(1, " lead and trail "), (2, "a\nb"), (3, 'q "x" | y'), (4, "back\\slash"), (5, None), (6, "")]
    df = spark.createDataFrame(rows, "id int, t string")
    back = read_staged(spark, write_delimited(df, str(tmp_path / "s")), df.schema, keep_empty=True).collect()
    assert sorted(tuple(r) for r in back) == rows


def test_store_assign_integers(spark):
    big = ColumnSpec("b", "bigint", None, True)
    one = lambda sql, spec: spark.sql(f"SELECT {sql} AS c").select(store_assign("c", spec).alias("v")).first().v
    assert one("9007199254740993L", big) == 9007199254740993
    assert one("'9007199254740993'", big) == 9007199254740993
    assert one("-1.9D", big) == -1 and one("'2.7'", big) == 2 and one("CAST(NULL AS DOUBLE)", big) is None


def test_unlisted_numbers(spark):
    m = field_map([(0, "zero"), (1, "one")])
    df = spark.createDataFrame([(1.0,), (1.7,), (-0.5,), (3e9,), (None,)], "c double")
    for form in ("c", F.col("c")):
        assert [r.v for r in df.select(map_expr(form, m).alias("v")).collect()] == ["one", None, None, None, None]


def test_equal_natural_keys_get_numbers_of_their_own(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (0, "z"), (1, "a"), (None, "n")], "k int, v string")
    got = sorted((r.id, r.k, r.v) for r in natural_key(df, ["k"], "id").collect())
    assert got == [(0, None, "n"), (1, 0, "z"), (2, 1, "a"), (3, 1, "a"), (4, 1, "b")]


def test_no_private_folder_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda *a: None)
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())
