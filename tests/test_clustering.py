"""Clustering operators against brute-force numpy on the smallest fixture, and invariance
of the results to partitioning."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoplens.operators import kmeans as K
from shoplens.operators.features import compute_scale
from shoplens.operators.joins import KeyRepeated, one_to_one
from shoplens.operators.model import XYZ
from shoplens.operators.segments import NotOneToOne, require_one_to_one
from shoplens.operators.sweeps import Batch, Unit
from shoplens.plans import catalog_eval
from shoplens.plans.build import Build
from shoplens.params import DEFAULT

from . import reference_numpy as R
from .conftest import SF_SMALL

SMALL = DEFAULT.with_(seeds=(0, 1, 2), k_values=(2, 3, 4), n_init=3)


@pytest.fixture(scope="module")
def build(spark):
    return Build.of(spark, SF_SMALL, SMALL)


@pytest.fixture(scope="module")
def points(build):
    rows = build.model.customers.select("customer_id", *XYZ).orderBy("customer_id").collect()
    return [r.customer_id for r in rows], [tuple(r[c] for c in XYZ) for r in rows]


def test_seeded_start_and_lloyd_match_brute_force(build, points):
    ids, X = points
    for fit, st in build.model.states.items():
        start = R.kpp(ids, X, st.spec.k, st.spec.seed, st.spec.init)
        assert [tuple(c) for c in st.initial] == start
        centres, _, it = R.lloyd(X, start)
        assert [tuple(c) for c in st.centres] == [tuple(c) for c in centres]
        assert st.iterations == it


def test_final_labels_and_silhouette(build, points, spark):
    ids, X = points
    best = build.model.best
    labels = R.assign(X, best.centres)
    seg = {r.customer_id: r.raw_cluster for r in build.segmented.select("customer_id", "raw_cluster").collect()}
    assert [seg[i] for i in ids] == labels
    from shoplens.operators.evaluate import silhouettes

    sizes = {0: [labels.count(j) for j in range(best.spec.k)]}
    lab = build.segmented.select(F.lit("base").alias("space"), "customer_id", F.col(XYZ[0]).alias("x"),
                                 F.col(XYZ[1]).alias("y"), F.col(XYZ[2]).alias("z"),
                                 F.array(F.col("raw_cluster").cast("int")).alias("labels"))
    got = silhouettes(lab, sizes, {"base": [0]}).first().silhouette
    assert got == pytest.approx(R.silhouette(X, labels), abs=1e-9)


def test_silhouette_with_several_column_blocks(build, points, monkeypatch):
    from shoplens.operators import evaluate

    ids, X = points
    labels = R.assign(X, build.model.best.centres)
    monkeypatch.setattr(evaluate, "COL_CELLS", 160)
    monkeypatch.setattr(evaluate, "ROW_BLOCK", 30)
    sizes = {0: [labels.count(j) for j in range(build.model.best.spec.k)]}
    lab = build.segmented.select(F.lit("base").alias("space"), "customer_id", F.col(XYZ[0]).alias("x"),
                                 F.col(XYZ[1]).alias("y"), F.col(XYZ[2]).alias("z"),
                                 F.array(F.col("raw_cluster").cast("int")).alias("labels"))
    got = evaluate.silhouettes(lab, sizes, {"base": [0]}).first().silhouette
    assert got == pytest.approx(R.silhouette(X, labels), abs=1e-9)


def scaled_points(sweep, space):
    rows = sweep.space(space).customers.select("customer_id", *XYZ).orderBy("customer_id").collect()
    return [r.customer_id for r in rows], [tuple(r[c] for c in XYZ) for r in rows]


def test_sweep_summary_matches_brute_force(build, spark):
    ids, X = scaled_points(build.sweep, "cap995")
    summary = {r.k: r for r in catalog_eval._summary(build, catalog_eval._k_units(SMALL)).collect()}
    for k in SMALL.k_values:
        labelings, inert, sils = [], [], []
        for s in SMALL.seeds:
            centres, labels, _ = R.lloyd(X, R.kpp(ids, X, k, s, 0))
            labelings.append(labels)
            inert.append(float(R.inertia(X, centres, labels)))
            sils.append(R.silhouette(X, labels))
        assert summary[k].median_inertia == pytest.approx(float(np.median(inert)), rel=1e-12)
        assert summary[k].median_silhouette_full == pytest.approx(float(np.median(sils)), abs=1e-9)
        assert summary[k].median_pairwise_ari == pytest.approx(float(np.median(R.pairwise(labelings))), abs=1e-12)


def test_equal_partitions_are_one_labeling(build, spark):
    """Distinct labelings are those of the brute-force partitions, each evaluated once and counted for all of its fits."""
    sweep = build.sweep
    ids, X = scaled_points(sweep, "cap995")
    for k in SMALL.k_values:
        unit = Unit("cap995", k)
        partitions = []
        for s in SMALL.seeds:
            _, labels, _ = R.lloyd(X, R.kpp(ids, X, k, s, 0))
            partitions.append(frozenset(frozenset(i for i, lab in zip(ids, labels) if lab == j) for j in set(labels)))
        assert sorted(n for _, n in sweep.labelings(unit)) == sorted(partitions.count(p) for p in set(partitions))
        assert sum(n for _, n in sweep.labelings(unit)) == len(SMALL.seeds)
        for a, b, ari in sweep.aris([unit])[unit]:
            same = partitions[SMALL.seeds.index(sweep.state(a).spec.seed)] == partitions[SMALL.seeds.index(sweep.state(b).spec.seed)]
            assert (ari == 1.0) == same
    # the same centres under other numbers are the same labeling
    st = sweep.state(sweep.fits(Unit("cap995", 3))[0])
    turned = K.FitState(K.FitSpec(1, "cap995", 3, 0), st.centres[::-1])
    first = K.FitState(K.FitSpec(0, "cap995", 3, 0), list(st.centres))
    batch = Batch(build.sweep._batch[st.spec.fit].points, {0: first, 1: turned}, {"cap995": [0, 1]})
    batch.measure()
    assert batch.same_as == {0: 0, 1: 0} and batch.sizes[0] == batch.sizes[1][::-1] and batch.inertia[0] == batch.inertia[1]


def test_units_run_once_and_only_when_asked(spark):
    build = Build(spark, SF_SMALL, SMALL)
    sweep = build.sweep
    sweep.run([Unit("cap995", 2)])
    assert set(sweep._spaces) == {"cap995"} and len(sweep._batch) == len(SMALL.seeds)
    states = [id(sweep.state(f)) for f in sweep.fits(Unit("cap995", 2))]
    sweep.run([Unit("cap995", 2), Unit("none", 3)])
    assert [id(sweep.state(f)) for f in sweep.fits(Unit("cap995", 2))] == states and len(sweep._batch) == 2 * len(SMALL.seeds)
    with pytest.raises(KeyError):
        sweep.space("unknown")


def test_tolerance_stops_earlier_with_a_closing_assignment(build, points):
    ids, X = points
    pts = build.model.points
    specs = [K.FitSpec(n, "base", 4, n, 0) for n in range(6)]
    strict, loose = K.fit_many(pts, specs, 300), K.fit_many(pts, specs, 300, tol=1e-2)
    assert {st.settled for st in strict.values()} == {"strict"} and "tolerance" in {st.settled for st in loose.values()}
    assert sum(st.iterations for st in loose.values()) < sum(st.iterations for st in strict.values())
    for f, st in loose.items():
        centres, labels, it = R.lloyd(X, R.kpp(ids, X, 4, f, 0), tol=1e-2)
        assert st.centres == centres and st.iterations == it
        found = {r.customer_id: r.label for r in K.assign(pts, [st]).collect()}
        assert [found[i] for i in ids] == labels
    assert K.tolerances(pts, 1e-4)["base"] == pytest.approx(1e-4 * np.var(np.asarray(X), axis=0).mean(), rel=1e-9)


def test_changed_ids_follow_the_trace(build, points):
    ids, X = points
    frames = build.trace
    found = sorted(tuple(r) for r in K.label_changes(build.model.points, frames).collect())
    labels = [R.assign(X, f["centres_before"]) for f in frames]
    expected = sorted((t + 1, i, a, b) for t in range(1, len(frames)) for i, a, b in zip(ids, labels[t - 1], labels[t]) if a != b)
    assert found == expected and frames[-1]["changed_count"] == 0
    assert [f["changed_count"] for f in frames[1:]] == [sum(e[0] == f["iteration"] for e in expected) for f in frames[1:]]


def test_trace_failures_are_named(build):
    pts = build.model.points
    far = [(0.0, 0.0, 0.0), (1e6, 1e6, 1e6)]
    lost = K.FitState(K.FitSpec(7, "base", 2, 0, 0), list(far), initial=list(far))
    sound = K.FitState(K.FitSpec(8, "base", 4, 0, 0), list(build.model.states[0].initial))
    K.run_lloyd(pts, {7: lost, 8: sound}, 300)  # the batch goes on
    assert lost.empty_rounds and lost.centres[1] == far[1] and not sound.empty_rounds and sound.settled == "strict"
    with pytest.raises(K.EmptyCluster, match="cluster \\[1\\]"):
        K.trace(pts, lost, 300)
    with pytest.warns(UserWarning, match="not settled"), pytest.raises(K.UnstableTrace):
        K.trace(pts, K.FitState(build.model.states[0].spec, [], initial=list(build.model.states[0].initial)), 2)
    with pytest.raises(NotOneToOne):
        require_one_to_one({0: "S1", 1: "S2", 2: "S2", 3: "S4"}, ["S1", "S2", "S3", "S4"])
    assert require_one_to_one({1: "S1", 0: "S2"}, ["S1", "S2"]) == {1: "S1", 0: "S2"}


def test_one_to_one_join_counts_both_sides(spark):
    one = spark.createDataFrame([(1, "a"), (2, "b")], "k long, x string")
    two = spark.createDataFrame([(2, 0.5), (3, 0.25)], "k long, y double")
    assert [tuple(r) for r in one_to_one(one, two, "k").collect()] == [(2, "b", 0.5)]
    for left, right, word in ((one.union(one.limit(1)), two, "left"), (one, two.union(two), "right"),
                              (one.union(spark.createDataFrame([(None, "c")], one.schema)), two, "null")):
        with pytest.raises(KeyRepeated, match=word):
            one_to_one(left, right, "k")
    assert one_to_one(one.limit(0), two, "k").collect() == []


def test_variance_keeps_small_spreads(spark):
    rows = [(i, 1_000_000.0 + (i % 3) * 1e-5, 0.25) for i in range(300)]
    df = spark.createDataFrame(rows, "a long, b double, c double")
    scale = compute_scale(df, [F.col("a").cast("double"), F.col("b"), F.col("c")])
    assert scale.stds[0] == pytest.approx(np.std(range(300)), rel=1e-12)
    assert scale.stds[1] == pytest.approx(np.std([0.0, 1e-5, 2e-5]), rel=1e-9) and scale.stds[2] == 0.0


def test_preprocessing_alternatives(build, spark):
    rows = {r.candidate: r for r in catalog_eval.preprocessing_comparison(spark, SF_SMALL, SMALL).collect()}
    rfm = build.rfm.select("recency", "frequency", F.col("net_monetary").cast("double").alias("m")).collect()
    raw = np.array([[r.recency, r.frequency, r.m] for r in rfm], float)
    _, robust = scaled_points(build.sweep, "robust")
    iqr = np.quantile(raw, 0.75, axis=0) - np.quantile(raw, 0.25, axis=0)
    want = (raw - np.median(raw, axis=0)) / iqr
    assert np.allclose(np.sort(np.array(robust), axis=0), np.sort(want, axis=0), atol=1e-9)
    positive = np.log1p(raw[raw[:, 2] > 0])
    _, logs = scaled_points(build.sweep, "log")
    assert np.allclose(np.sort(np.array(logs), axis=0), np.sort((positive - positive.mean(0)) / positive.std(0), axis=0), atol=1e-6)
    assert rows["Log / k=3"].customers == len(positive) and rows["Robust / k=2"].customers == len(raw)
    for (label, space, k) in catalog_eval.PREPROCESSING:
        ids, X = scaled_points(build.sweep, space)
        tries = [R.lloyd(X, R.kpp(ids, X, k, SMALL.seed, i)) for i in range(SMALL.n_init)]
        centres, labels, _ = min(tries, key=lambda t: float(R.inertia(X, t[0], t[1])))
        assert rows[label].silhouette_full == pytest.approx(R.silhouette(X, labels), abs=1e-6)
        assert rows[label].min_cluster_size == min(labels.count(j) for j in range(k))


def test_fit_does_not_depend_on_partitioning(build, spark):
    pts = build.model.points
    specs = [K.FitSpec(0, "base", 4, 7, 0)]
    one = K.fit_many(pts.coalesce(1), specs, 300)[0]
    many = K.fit_many(pts.repartition(5), specs, 300)[0]
    assert one.centres == many.centres and one.initial == many.initial


def test_sweep_queries_run_and_are_complete(build, spark):
    from shoplens.plans import catalog_eval as CE

    comp = {r.check_name: r for r in CE.evidence_completeness(spark, SF_SMALL, SMALL).collect()}
    assert all(comp[n].complete for n in ("k_selection", "cap_sensitivity", "directed_sensitivity"))
    assert comp["no_hard_stop"].expected == len(SMALL.variants)
    d = CE.directed_sensitivity(spark, SF_SMALL, SMALL).collect()
    assert {r.variant_id for r in d} == set(SMALL.variants)
    assert all(-1.0 <= r.representative_common_ari <= 1.0 for r in d)
    piv = CE.evidence_pivot(spark, SF_SMALL, SMALL).orderBy("evidence_type", "candidate_order").collect()
    kinds = [("cap_sensitivity", name) for name, _ in SMALL.cap_specs] + [("directed_sensitivity", v) for v in SMALL.variants]
    kinds += [("k_selection", k) for k in sorted(SMALL.k_values)] + [("preprocessing", label) for label, _, _ in CE.PREPROCESSING]
    assert [(r.evidence_type, r.k if r.evidence_type == "k_selection" else r.candidate) for r in piv] == kinds
    assert all(r.complete for r in piv)
    long = CE.evidence_long(spark, SF_SMALL, SMALL).groupBy("evidence_type").count().collect()
    assert {r.evidence_type: r["count"] for r in long} == {"k_selection": 4 * len(SMALL.k_values), "cap_sensitivity": 16, "directed_sensitivity": 12, "preprocessing": 12}
    caps = {r.threshold_id: r for r in CE.cap_sensitivity(spark, SF_SMALL, SMALL).collect()}
    assert caps["none"].either_affected == 0 and caps["cap990"].either_affected >= caps["cap999"].either_affected
