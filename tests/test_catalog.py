"""Every registered query against its SQL twin, or at least for rows."""

import pytest

from compare import SAME_TYPE, duck, duck_types, rows_of_duck, rows_of_spark
from loomwork.catalog import REGISTRY


@pytest.fixture(scope="module")
def connection(data):
    with duck(data) as found:
        yield found


@pytest.mark.parametrize("name", sorted(n for n, q in REGISTRY.items() if q.sql))
def test_query_agrees_with_sql(spark, data, connection, name):
    query = REGISTRY[name]
    df = query(spark, data)
    spark_names, spark_rows = rows_of_spark(df)
    duck_names, duck_rows = rows_of_duck(connection, query.sql)
    assert spark_names == duck_names
    assert sum(spark_rows.values()) == sum(duck_rows.values())
    only_spark, only_duck = spark_rows - duck_rows, duck_rows - spark_rows
    assert not only_spark and not only_duck, (
        list(only_spark.items())[:3],
        list(only_duck.items())[:3],
    )
    kinds = duck_types(connection, query.sql)
    for field in df.schema.fields:
        assert SAME_TYPE[field.dataType.simpleString()] == kinds[field.name], field.name


@pytest.mark.parametrize("name", sorted(n for n, q in REGISTRY.items() if not q.sql))
def test_query_without_sql_gives_rows(spark, data, name):
    assert REGISTRY[name](spark, data).count() > 0


def test_entry_points():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(REGISTRY) <= set(entry.queries())
