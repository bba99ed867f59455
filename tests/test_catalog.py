"""Every registered query against its SQL, and rules about the plans."""

import pytest
from compare import rows

from __spark_entry__ import entry, oracle_sql, queries
from lectern.plans.catalog import QUERIES
from lectern.sources import readers


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sql, small, name):
    df = queries()[name](spark, small)
    ours = rows(df.columns, df.collect())
    assert ours
    cursor = sql.execute(oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert ours == rows(columns, cursor.fetchall())


def test_entry_has_rows(spark):
    assert entry(spark).limit(1).count() == 1


def physical_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    ["tfidf_topk", "idf", "enrich_text", "section_texts", "status_lookup", "status_missing", "result_lookup",
     "processed_requests", "request_batch_explode", "flat_export_winners", "latest_status"],
)
def test_no_pairwise_joins(spark, small, name):
    plan = physical_plan(queries()[name](spark, small))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize(
    "name", ["html_blocks", "extract_text", "page_title", "term_frequency", "route_requests", "request_to_json"]
)
def test_row_local_operators_do_not_shuffle(spark, small, name, monkeypatch):
    # Without the step that spreads a single small file over the cores.
    monkeypatch.setattr(readers, "spread", lambda df, *keys: df)
    assert "Exchange" not in physical_plan(queries()[name](spark, small))


def test_no_python_in_the_plans(spark, small):
    for name in ("tfidf_topk", "extract_text", "section_texts", "processed_requests"):
        plan = physical_plan(queries()[name](spark, small))
        assert "Python" not in plan and "Arrow" not in plan


def test_scan_reads_only_needed_columns(spark, small):
    assert "ReadSchema: struct<text:string>" in physical_plan(queries()["content_scan"](spark, small))
    assert "content" not in physical_plan(queries()["file_manifest"](spark, small)).split("ReadSchema")[1]
