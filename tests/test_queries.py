import pytest

from stratakey.plans import queries


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_gives_the_rows_of_its_sql(name, same):
    same(queries.QUERIES[name], queries.SQL[name])


def test_every_query_has_sql():
    assert set(queries.QUERIES) == set(queries.SQL)


def test_entry_points(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["o_orderkey", "o_custkey", "o_totalprice", "c_name", "c_acctbal"]
    assert set(e.oracle_sql()) <= set(e.queries())
    assert set(queries.QUERIES) <= set(e.queries())


def test_scan_reads_two_columns_and_pushes_the_predicate(spark):
    from .conftest import SF

    plan = queries.point_select(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(user_id,3)" in plan and "EqualTo(event_type,click)" in plan
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string>" in plan


def test_lookup_of_a_small_dimension_is_broadcast(spark):
    from .conftest import SF

    assert "BroadcastHashJoin" in queries.lookup_left(spark, SF)._jdf.queryExecution().executedPlan().toString()
