"""A written build read back: look-ups, filters, ordered scans, slices, verification."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from shoplens.operators.audit import archive_comparison, expectation_report, require_passed
from shoplens.plans.build import Build
from shoplens.sources import sinks
from shoplens.operators.constraints import Constraints, constraint_report, table_report
from shoplens.sources.repository import SLICES, StoredBuild

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def stored(spark):
    out = tempfile.mkdtemp(prefix="shoplens-stored-", dir="/tmp")
    sinks.write_build(Build.of(spark, SF_SMALL), out)
    return StoredBuild(spark, out)


def test_lookups(spark, stored):
    live = Build.of(spark, SF_SMALL).segmented
    some = live.orderBy("customer_id").first()
    assert stored.customer(some.customer_id)["segment_code"] == some.segment_code
    with pytest.raises(KeyError):
        stored.customer("nobody")
    top = stored.representative_ids()["S4"]
    assert stored.customer_or_first("nobody")["customer_id"] == top == stored.customer_or_first(None)["customer_id"]
    assert stored.profile("S1")["segment_code"] == "S1"
    with pytest.raises(KeyError):
        stored.profile("S9")


def test_ordered_scans_and_filters(spark, stored):
    ids = [r.line_id for r in stored.lines().select("line_id").collect()]
    assert ids == sorted(ids) and ids[0] == 1
    assert [r.segment_code for r in stored.profiles().collect()] == ["S1", "S2", "S3", "S4"]
    found = stored.filtered_customers(["S1", "S4"], ["ASIA"], "uncapped").collect()
    keys = [(r.segment_code, r.customer_id) for r in found]
    assert keys and keys == sorted(keys) and {k for k, _ in keys} <= {"S1", "S4"} and not any(r.any_capped_flag for r in found)
    asia = {r.customer_id for r in stored.table("customer_countries").where("country = 'ASIA'").collect()}
    assert {c for _, c in keys} <= asia
    top = stored.representative_ids()["S4"]
    times = [(r.invoice_date, r.invoice_no) for r in stored.timeline(top).collect()]
    assert times and times == sorted(times)
    assert "customer_id" in stored.timeline(top)._jdf.queryExecution().executedPlan().toString().split("PushedFilters")[1][:200]


def test_slices_and_options(stored):
    for axes, (x, y) in SLICES.items():
        got = {r.customer_id: (r.x, r.y) for r in stored.points(axes, segments=["S2"]).collect()}
        want = {r.customer_id: (r[x], r[y]) for r in stored.customers.where("segment_code = 'S2'").collect()}
        assert got == want
    assert sorted(map(tuple, stored.points("xy").collect())) == sorted(map(tuple, stored.points("rf").collect()))
    countries = [r.country for r in stored.country_options("EUROPE").collect()]
    assert countries[0] == "EUROPE" and countries[1:] == sorted(countries[1:])
    assert stored.customer_options().first().label


def test_verification_reports_and_raises(spark, stored):
    assert stored.verify({"profiles": 4.0}).where("not passed").count() == 0
    with pytest.raises(ValueError, match="profiles: expected 5.0"):
        stored.verify({"profiles": 5.0})
    seg = stored.table("customer_segments")
    broken = tempfile.mkdtemp(prefix="shoplens-broken-", dir="/tmp")
    for name in os.listdir(stored.path):
        if name not in ("customer_segments", "_manifest"):
            stored.table(name).write.mode("overwrite").parquet(os.path.join(broken, name))
    spark.read.text(os.path.join(stored.path, "_manifest")).write.text(os.path.join(broken, "_manifest"))
    first = seg.orderBy("customer_id").first().customer_id
    seg.withColumn("segment_code", F.when(F.col("customer_id") == first, "S0").otherwise(F.col("segment_code"))).write.parquet(
        os.path.join(broken, "customer_segments"))
    assert StoredBuild(spark, broken).changed_tables() == ["customer_segments"]
    with pytest.raises(ValueError, match="assignment_fingerprint.*content:customer_segments"):
        StoredBuild(spark, broken).verify()


def test_digests_do_not_see_order_but_every_change(spark, stored):
    moved = tempfile.mkdtemp(prefix="shoplens-moved-", dir="/tmp")
    for name in os.listdir(stored.path):
        if name != "_manifest":
            stored.table(name).repartition(3).orderBy(F.rand(1)).write.mode("overwrite").parquet(os.path.join(moved, name))
    spark.read.text(os.path.join(stored.path, "_manifest")).write.text(os.path.join(moved, "_manifest"))
    again = StoredBuild(spark, moved)
    assert again.changed_tables() == [] and again.verify().where("not passed").count() == 0
    fewer = stored.table("invoice_timeline").limit(stored.manifest["counts"]["invoice_timeline"] - 1)
    fewer.write.mode("overwrite").parquet(os.path.join(moved, "invoice_timeline"))
    assert again.changed_tables() == ["invoice_timeline"]


def test_constraints_are_counted_in_one_scan(spark):
    rows = [(1, "a", 1, 10), (1, "b", 0, 11), (2, None, 2, 12), (None, "c", None, 99), (3, "a", 1, 10), (None, None, 1, None)]
    child = spark.createDataFrame(rows, "id int, name string, flag int, ref int")
    parent = spark.createDataFrame([(10,), (11,), (12,), (12,)], "ref int")
    c = Constraints("t", ("id", "name"), {"primary_key": ("id",), "unique:pair": ("id", "name")}, {"flag": "flag IN (0, 1)"}, ((("ref",), "p"),))
    found = {r.constraint_name: r.violations for r in constraint_report({"t": child, "p": parent}, [c]).collect()}
    assert found == {"not_null:id": 2, "not_null:name": 2, "primary_key": 1, "unique:pair": 0, "check:flag": 1, "foreign_key:ref->p": 1}
    plan = table_report(child, c)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1
    empty = {r.constraint_name: r.violations for r in constraint_report({"t": child.limit(0), "p": parent}, [c]).collect()}
    assert set(empty.values()) == {0}


def test_expected_facts_and_archives(spark):
    report = expectation_report(spark, {"a": 1.0, "b": "x"}, {"a": 1.0000001, "b": "y", "c": 2})
    assert {r.check_name: r.passed for r in report.collect()} == {"a": True, "b": False, "c": False}
    with pytest.raises(ValueError, match="b: .*; c: "):
        require_passed(report)
    now = spark.createDataFrame([(2, 1.0, 5.0), (3, 2.0, 6.0)], "k int, inertia double, ari double")
    old = spark.createDataFrame([(2, 1.0 + 1e-12, 5.1), (4, 1.0, 1.0)], "k int, inertia double, ari double")
    passed = {(r.k, r.metric): r.passed for r in archive_comparison(now, old, ["k"], ["inertia", "ari"]).collect()}
    assert passed == {(2, "inertia"): True, (2, "ari"): False, (3, "inertia"): False, (3, "ari"): False, (4, "inertia"): False, (4, "ari"): False}
