"""Exact quantiles, scale statistics and running ranks: values, plans and independence of partitions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoplens.operators.features import apply_caps, compute_caps, compute_scale
from shoplens.operators.lines import running_ranks
from shoplens.operators.quantiles import exact_quantiles

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def values(spark):
    rng = np.random.default_rng(7)
    rows = [(["a", "b", "c"][i % 3], float(v)) for i, v in enumerate(rng.integers(0, 50, 3001))]
    rows += [("d", 5.0)] * 7  # ties only
    return spark.createDataFrame(rows, "g string, v double").repartition(5)


def test_quantiles_equal_sorted_values(values):
    probs = [0.0, 0.25, 0.5, 0.75, 0.995, 1.0]
    got = {(r.g, r.p): r.q for r in exact_quantiles(values, ["g"], "v", probs).collect()}
    pdf = values.toPandas()
    for g, grp in pdf.groupby("g"):
        for p in probs:
            assert got.pop((g, p)) == pytest.approx(float(grp["v"].quantile(p)), abs=1e-9)
    assert not got


def test_global_quantile_with_wide_values_nulls_and_a_null_group(spark):
    rng = np.random.default_rng(3)
    v = np.concatenate([rng.normal(0, 1e6, 30_000), np.full(20_000, 12.5)])
    rows = [(None if i % 7 == 0 else "x", float(x)) for i, x in enumerate(v)] + [("x", None)] * 50
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    for p in (0.001, 0.33, 0.5, 0.995):
        assert exact_quantiles(df, [], "v", [p]).first().q == pytest.approx(float(np.quantile(v, p)), rel=1e-12)
    by = {r.g: r.q for r in exact_quantiles(df, ["g"], "v", [0.5]).collect()}
    assert by.keys() == {None, "x"}
    assert by[None] == pytest.approx(float(np.quantile(v[::7], 0.5)))


def test_quantile_plan_has_no_single_task_over_rows(values):
    plan = exact_quantiles(values, [], "v", [0.5])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "percentile(" not in plan


def test_caps_and_scale_do_not_depend_on_partitions(spark):
    from shoplens.plans.build import Build

    rfm = Build.of(spark, SF_SMALL).rfm
    seen = set()
    for n in (1, 4, 16):
        part = rfm.repartition(n)
        caps = compute_caps(part, 0.995)
        seen.add((caps, compute_scale(apply_caps(part, caps))))
    assert len(seen) == 1


def test_running_ranks_leave_large_integers_beside_nulls_alone(spark):
    big = 9007199254740993
    df = spark.createDataFrame([(1, big), (2, None), (3, big + 2)], "k long, n long").repartition(3)
    got = running_ranks(df, ["k"], {"pos": F.lit(1)}, {"pos": 1}).orderBy("k").collect()
    assert [(r.n, r.pos) for r in got] == [(big, 1), (None, 2), (big + 2, 3)]


def test_running_ranks_are_contiguous_and_ordered(spark, values):
    ranked = running_ranks(values, ["g", "v"], {"pos": F.lit(1), "heavy": F.when(F.col("v") > 25, 2).otherwise(0)},
                           {"pos": 1, "heavy": 0}).toPandas()
    ranked = ranked.sort_values("pos").reset_index(drop=True)
    assert ranked["pos"].tolist() == list(range(1, len(ranked) + 1))
    keys = list(zip(ranked["g"], ranked["v"]))
    assert keys == sorted(keys)
    w = np.where(ranked["v"] > 25, 2, 0)
    assert ranked["heavy"].tolist() == (np.cumsum(w) - w).tolist()
