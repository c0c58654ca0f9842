import __spark_entry__ as E
from conftest import SF_SMALL


def test_contract_functions(spark):
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    assert len(sqls) >= 34
    df = E.entry(spark)
    assert len(df.columns) > 0
    df.limit(5).collect()


def test_every_query_runs_small(spark):
    for name, fn in E.queries().items():
        fn(spark, SF_SMALL).write.format("noop").mode("overwrite").save()
