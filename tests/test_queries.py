"""Every query of the rest of the library against its SQL in DuckDB, on the smallest tables."""

import decimal
import os
import re

import duckdb
import pytest

from tessera.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


#: Queries whose plan has a nested-loop join: with a side of one row (a total, a newest time).
ONE_ROW = {
    "class_signatures", "coverage_identity", "document_frequency", "exam_subject_matrix", "importance_by_hierarchy", "ledger_tail_window", "outage_reason", "precision_threshold",
    "priority_by_subject", "priority_overall", "rarity_buckets", "rule_score_top1_margin", "rule_shortlist", "share_of_total", "index_distribution", "settings_scope",
}
#: Queries with a window over all rows of a small table: parts of a range, distinct values of a list, the ten best.
SMALL_WINDOW = {"precision_threshold", "subject_order", "priority_overall"}


def one_task_window(plan):
    lines = plan.split("\n")
    return any(re.match(r"[\s:|+-]*(\*\(\d+\) )?Window \[", v) and any("SinglePartition" in x for x in lines[i + 1 : i + 4]) for i, v in enumerate(lines))


def plain(v):
    return round(float(v), 6) if isinstance(v, (float, decimal.Decimal)) else v


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_matches_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(v) for v in r) for r in df.select(*cols).collect()), key=repr)
    rel = duck.sql(registry.SQL[name])
    at = [rel.columns.index(c) for c in cols]
    assert sorted(rel.columns) == cols
    want = sorted((tuple(plain(r[i]) for i in at) for r in rel.fetchall()), key=repr)
    assert got == want
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "NestedLoopJoin" not in plan or name in ONE_ROW
    assert not one_task_window(plan) or name in SMALL_WINDOW


def test_queries_have_rows(spark):
    """The rules of an audit find something in the inputs chosen for them."""
    for name in ("foreign_vocabulary", "audit_ownership"):
        assert registry.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
