import re

import __spark_entry__ as spark_entry
from matchlake.plans.catalogue import QUERIES

SMALL = "/root/testdata/sf0.001"


def test_register():
    queries, checks = spark_entry.queries(), spark_entry.oracle_sql()
    assert set(checks) <= set(queries)
    assert set(QUERIES) <= set(queries) and set(QUERIES) - set(checks) == {"token_set_match", "resolve_names"}


def test_entry(spark):
    df = spark_entry.entry(spark)
    assert df.count() == 10 and "economy_rate" in df.columns


def test_plans_have_no_all_pairs_joins(spark):
    for name, build in spark_entry.queries().items():
        if not name.startswith(("an_", "shape_", "enrich", "timing")) or name in ("an_raw_json_deliveries", "an_text_hat_trick"):
            continue
        plan = build(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("CartesianProduct|NestedLoopJoin", plan), name


def test_scans_read_only_what_is_asked_for(spark):
    plan = spark_entry.queries()["an_boundary_count"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert schema == "l_orderkey:bigint,l_partkey:bigint,l_quantity:double"
    ranged = spark_entry.queries()["shape_filter"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "In(l_returnflag, [A,N]), GreaterThanOrEqual(l_quan" in ranged
