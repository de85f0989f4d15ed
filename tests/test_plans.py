"""Plan regressions for the scale properties (read from the executed plan, no UI)."""

import datetime

from shoplens.operators import lines as L
from shoplens.plans import catalog_model
from shoplens.plans.build import Build
from shoplens.sources.adapter import source_lines

from .conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_customer_filter_reaches_the_scan(spark):
    plan = _plan(catalog_model.customer_timeline(spark, SF_SMALL))
    assert "EqualTo(n_customer_id" in plan


def test_star_joins_run_once(spark):
    b = Build.of(spark, SF_SMALL)
    plan = _plan(L.deduplicate(b.raw))
    assert plan.count("Scan parquet") == 6  # lineitem, orders, part, supplier, nation, region: once each


def test_line_scans_are_pruned(spark):
    from shoplens.operators.rfm import build_rfm

    b = Build.of(spark, SF_SMALL)
    plan = _plan(build_rfm(b.lines, b.params))
    assert "description" not in plan.split("ReadSchema")[1].split("\n")[0]


def _star_tables(spark) -> str:
    """Small star tables with keys that repeat, are null or have no partner."""
    import tempfile

    root = tempfile.mkdtemp(prefix="shoplens-star-", dir="/tmp")
    tables = {
        "region": ("r_regionkey int, r_name string", [(0, "EUROPE"), (1, "ASIA")]),
        "nation": ("n_nationkey int, n_regionkey int", [(0, 0), (1, 1), (2, None)]),
        "supplier": ("s_suppkey long, s_nationkey int", [(1, 0), (2, 1), (2, 0), (3, None), (4, 2)]),
        "part": ("p_partkey long, p_name string, p_type string", [(1, "cup", "PROMO"), (1, "cup", "STANDARD"), (2, "mug", None), (2, "jar", "PROMO"), (50, None, "X")]),
        "orders": ("o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string",
                   [(k, k % 3, datetime.datetime(2001, 1, 1 + k % 7), "5-LOW" if k % 4 == 0 else "1-URGENT") for k in (1, 2, 2, 3, 50, 100)] + [(None, 1, None, None)]),
        "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_returnflag string",
                     [(o, p, s, 2.0, 10.0, f) for o in (1, 2, 3, 50, 50, 100, 7, None) for p in (1, 2, 50, 9) for s in (1, 2, 3, 4, 9) for f in ("R", "N", None)]),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}.parquet")
    return root


def test_copies_are_removed_without_a_shuffle_of_their_own(spark):
    root = _star_tables(spark)
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for large tables
    try:
        keyed = L.deduplicate(source_lines(spark, root, keyed=True))
        plan = _plan(keyed)
        assert plan.count("Exchange hashpartitioning") == 6 and "hashpartitioning(invoice_no" not in plan and "hashpartitioning(line_key" not in plan
        plain = L.deduplicate(source_lines(spark, root))
        assert keyed.columns == plain.columns
        rows = sorted(map(str, keyed.collect()))
        assert rows == sorted(map(str, plain.collect())) and len(rows) > 50
        assert keyed.agg({"copies": "sum"}).first()[0] == source_lines(spark, root).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_a_small_supplier_table_costs_no_shuffle_of_the_lines(spark):
    plan = _plan(source_lines(spark, SF_SMALL))
    assert "SortMergeJoin" not in plan or "hashpartitioning(l_suppkey" not in plan
    assert "hashpartitioning(s_suppkey" not in plan


def test_row_numbers_of_files_shuffle_no_lines(spark, tmp_path):
    from shoplens.params import SOURCE_COLUMNS
    from shoplens.sources.csv_source import in_source_order

    (tmp_path / "a.csv").write_text(",".join(SOURCE_COLUMNS) + "\n" + "1,2,cup,3,2001-01-01,1.5,7,EUROPE\n" * 5)
    plan = _plan(in_source_order(spark, str(tmp_path)))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
