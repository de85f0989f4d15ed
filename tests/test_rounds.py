"""Lloyd rounds on Arrow batches against their SQL text, the strict end of default fits, streamed silhouettes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoplens.operators import evaluate, kmeans as K, nearest
from shoplens.operators.model import iteration_input
from shoplens.operators.nearest import Centres, centre, label_vectors, least_of_fits, round_sums, rounded, whole_units
from shoplens.params import DEFAULT
from shoplens.plans import oracles

from . import reference_numpy as R

SCHEMA = "space string, customer_id string, x double, y double, z double"


def cloud(spark, n, seed=5):
    rng = np.random.default_rng(seed)
    at = np.round(rng.normal(size=(n, 3)) * [1, 3, 40], 10)
    return [tuple(map(float, p)) for p in at], spark.createDataFrame([("a", f"{i:04d}", *map(float, p)) for i, p in enumerate(at)], SCHEMA)


def test_round_sums_are_those_of_the_sql_round(spark):
    _, some = cloud(spark, 400)
    odd = [("a", "n1", None, 1.0, 2.0), ("a", "n2", 1.0, None, -3.5), ("a", "tie", 0.5, 0.5, 0.5), ("a", "big", 50000.25, -50000.0, 12345.6789012346), ("b", "1", 1.0, 2.0, 3.0),
           ("b", "2", -1.0, 0.123456789051, 3.0), ("c", "unused", 7.0, 7.0, 7.0)]
    points = some.unionByName(spark.createDataFrame(odd, SCHEMA)).repartition(3)
    states = [K.FitState(K.FitSpec(0, "a", 3, 0), [(0.0, 0.0, 0.0), (1.0, 1.0, 1.0), (-2.0, 3.0, 30.0)]),
              K.FitState(K.FitSpec(1, "a", 2, 0), [(1.0, 1.0, 1.0), (0.0, 0.0, 0.0)]), K.FitState(K.FitSpec(2, "b", 1, 0), [(9.0, 9.0, 9.0)])]
    want = {(r.fit, r.l): (r.n, r.x, r.y, r.z) for r in K.one_round(points, states).collect()}
    got = {(r.fit, r.l): (r.n, *centre(r)) for r in round_sums(points, K.centres_by_space(states)).collect()}
    assert got == want


def test_labels_compare_rounded_distances():
    """Distances that are equal after rounding go to the lower label, even where the higher one is nearer before it."""
    points = np.array([[0.0, 0.0, 0.0], [1.0, 0.0, 0.0]])
    fits = [[(1.0 + 1e-11, 0.0, 0.0), (1.0, 0.0, 0.0)], [(2.0, 0.0, 0.0)]]
    assert Centres(fits).labels(points).tolist() == [[0, 0], [0, 0]]
    assert whole_units(np.array([0.12345678905, -1.5, 250000.1234567891])).tolist() == [1234567891, -15000000000, 2500001234567891]


def test_default_fits_end_strictly(spark):
    X, points = cloud(spark, 3000, 11)
    points = points.coalesce(1).cache()
    specs = [K.FitSpec(n, "a", 4, n) for n in range(3)]
    for f, st in K.fit_many(points, specs, DEFAULT.max_iter, tol=DEFAULT.tol).items():
        assert st.settled == "strict"
        held = np.array(R.assign(X, st.centres))
        for j, c in enumerate(st.centres):
            assert np.allclose(np.array(X)[held == j].mean(axis=0), c, atol=1e-9)
    for name in ("customer_segments", "inertia_by_k", "ari_seed_pairs"):
        text = oracles.all_oracles()[name]
        assert "var_pop" not in text and "bool_or(nx <> cx OR ny <> cy OR nz <> cz)" in text


def test_silhouette_copies_points_to_a_bounded_number_of_blocks(spark, monkeypatch):
    X, points = cloud(spark, 203)
    monkeypatch.setattr(evaluate, "ROW_BLOCK", 1)
    monkeypatch.setattr(evaluate, "BLOCKS", 3)
    labels = [[i % 3 for i in range(203)], [int(p[2] > 0) for p in X], [0] * 202 + [1]]
    vectors = spark.createDataFrame([(f"{i:04d}", [v[i] for v in labels]) for i in range(203)], "customer_id string, labels array<int>")
    sizes = {f: [v.count(j) for j in range(max(v) + 1)] for f, v in enumerate(labels)}
    labelled = points.join(vectors, "customer_id")
    plans = []
    real = type(labelled).repartitionById
    monkeypatch.setattr(type(labelled), "repartitionById", lambda df, n, key: plans.append(n) or real(df, n, key))
    got = {r.fit: r.silhouette for r in evaluate.silhouettes(labelled, sizes, {"a": [0, 1, 2]}).collect()}
    assert plans == [3]
    for f, v in enumerate(labels):
        assert got[f] == pytest.approx(R.silhouette(X, v), abs=1e-9)


def test_label_changes_of_points_without_coordinates(spark):
    points = spark.createDataFrame([("a", "1", None, 0.0, 0.0), ("a", "2", 1.0, 0.0, 0.0)], SCHEMA)
    frames = [{"centres_before": [(1.0, 0.0, 0.0), (5.0, 0.0, 0.0)]}, {"centres_before": [(9.0, 0.0, 0.0), (1.0, 0.0, 0.0)]}]
    assert [tuple(r) for r in K.label_changes(points, frames).collect()] == [(2, "2", 0, 1)]
    assert K.label_changes(points.where(F.lit(False)), frames).collect() == []


def test_seeding_neither_sorts_nor_shuffles_point_rows(spark):
    """The least row of each fit leaves its task alone; equal scores go to the lower id, missing coordinates stay missing."""
    rows = [(f, float((i * 7 + f) % 5), f"{i:03d}", None if i == 5 else float(i), 0.0, 1.0) for f in (3, 9) for i in range(40)] + [(4, float("inf"), c, 1.0, 2.0, 3.0) for c in "ba"]
    table = spark.createDataFrame(rows, "fit int, s double, customer_id string, x double, y double, z double").repartition(3)
    found = least_of_fits(table)
    want = {f: min((r[1], r[2]) for r in rows if r[0] == f) for f in (3, 4, 9)}
    assert {r.fit: (r.p.s, r.p.customer_id) for r in found.collect()} == want
    assert {r.fit: r.p.x for r in found.collect()}[3] == next(r[3] for r in rows if r[:3] == (3, *want[3]))
    plan = least_of_fits(table)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("MapInArrow"):]
    assert "Sort" not in below and "Aggregate" not in below


def test_fits_of_one_seed_share_a_start_and_pick_as_the_sql_text(spark, monkeypatch):
    _, some = cloud(spark, 300)
    odd = [("a", None, 9.0, 9.0, 9.0), ("a", "gone", None, 1.0, 2.0), ("b", "same1", 1.0, 1.0, 1.0), ("b", "same0", 1.0, 1.0, 1.0), ("a", "far", 90000.5, -70000.25, 1.0)]
    points = some.unionByName(spark.createDataFrame(odd, SCHEMA)).repartition(4).cache()
    specs = [K.FitSpec(n, sp, k, seed, init) for n, (sp, k, seed, init) in enumerate(
        [("a", 2, 1, 0), ("a", 5, 1, 0), ("a", 3, 1, 0), ("a", 4, 2, 0), ("a", 4, 1, 1), ("b", 2, 1, 0)])]
    drawn = []
    real = K.seed_picks
    monkeypatch.setattr(K, "seed_picks", lambda points, fits, step: drawn.append(sorted(f[0] for m in fits.values() for f in m)) or real(points, fits, step))
    states = K.seed_centres(points, specs)
    assert drawn == [[1, 3, 4, 5], [1, 3, 4, 5], [1, 3, 4], [1, 3, 4], [1]]
    for st in states.values():
        assert len(st.picks) == len(st.initial) == st.spec.k
        for step in range(st.spec.k):
            one = K.FitState(st.spec, st.initial[:step])
            view, kmax = K.fits_view(spark, [one])
            rows = spark.sql(K.seed_sql(K.points_view(points), view, kmax, step)).collect()
            p = min(rows, key=lambda r: (r.s, r.customer_id is not None, r.customer_id or ""))
            assert (st.picks[step], st.initial[step]) == (p.customer_id, (p.x, p.y, p.z))
    assert states[5].picks[1] == "same0"  # no distance left: the lower id


def test_label_vectors_are_the_assignments(spark):
    _, some = cloud(spark, 300)
    odd = [("a", "gone", None, 1.0, 2.0), ("b", "1", 1.0, 2.0, 3.0), ("c", "unused", 7.0, 7.0, 7.0), ("a", "far", 90000.5, -70000.25, 1.0)]
    points = some.unionByName(spark.createDataFrame(odd, SCHEMA)).repartition(3)
    states = [K.FitState(K.FitSpec(0, "a", 3, 0), [(0.0, 0.0, 0.0), (1.0, 1.0, 1.0), (-2.0, 3.0, 30.0)]),
              K.FitState(K.FitSpec(1, "a", 2, 0), [(1.0, 1.0, 1.0), (0.0, 0.0, 0.0)]), K.FitState(K.FitSpec(2, "b", 1, 0), [(9.0, 9.0, 9.0)])]
    want = {(r.customer_id, r.fit): (r.label, r.d2) for r in K.assign(points, states).collect()}
    order = {"a": [0, 1], "b": [2]}
    got = {}
    for r in label_vectors(points, {sp: [states[f].centres for f in fl] for sp, fl in order.items()}).collect():
        got.update({(r.customer_id, f): (lab, d2) for f, lab, d2 in zip(order[r.space], r.labels, r.d2s, strict=True)})
    assert got == want
    assert rounded(np.array([0.12345678905, 0.0, 4.9e-11, 5e-11, 1e15 + 0.125])).tolist() == [0.1234567891, 0.0, 0.0, 1e-10, 1e15 + 0.125]


def test_labels_of_near_ties_and_fits_of_unequal_width():
    """The first of equal centres wins, one within the rounding of distances wins by its place; fillers never win."""
    tiny = 1e-12
    sets = [[(0.0, 0.0, 0.0), (0.0, 0.0, 0.0), (5.0, 0.0, 0.0)], [(1.0 + tiny, 0.0, 0.0), (-1.0, 0.0, 0.0)], [(3.0, 0.0, 0.0)]]
    c = Centres(sets)
    points = np.array([[0.0, 0.0, 0.0], [4.0, 1.0, 0.0], [-2.0, 0.0, 1.0]])
    assert c.labels(points).tolist() == [[0, 0, 0], [2, 0, 0], [0, 1, 0]]
    assert c.least(points).tolist() == [[0.0, 1.0, 9.0], [2.0, 10.0, 2.0], [5.0, 2.0, 26.0]]


def test_silhouette_columns_with_equal_labels_are_added_up_first(monkeypatch):
    """Ordered by label vector, columns meet the clusters of all labelings once a vector, not once a column; in any order the sums are those
    of all pairs."""
    rng = np.random.default_rng(5)
    at, vectors = rng.normal(size=(300, 3)), rng.integers(0, 3, size=(4, 7))
    of = rng.integers(0, 4, size=300)
    far = np.sqrt(((at[:, None] - at[None]) ** 2).sum(axis=2))
    for ordered, order in ((True, np.argsort(of)), (False, rng.permutation(300))):
        widest = []

        class Seen(np.ndarray):
            def __matmul__(self, other):
                widest.append((self.shape[1], other.shape[1]))
                return np.asarray(self) @ np.asarray(other)

        block = evaluate._Block(list(range(7)), {f: [1, 1, 1] for f in range(7)})
        block.add_rows(at[:40], vectors[of[:40]])
        real = np.empty
        monkeypatch.setattr(evaluate.np, "empty", lambda *a, **k: real(*a, **k).view(Seen))
        block.add_columns(at[order], vectors[of[order]])
        monkeypatch.undo()
        expected = [far[:40][:, vectors[of][:, f] == c].sum(axis=1) for f in range(7) for c in range(3)]
        assert np.allclose(block.sums, np.array(expected).T, rtol=1e-12)
        assert max(width for columns, width in widest if columns == 300) == (4 if ordered else 21)


def test_a_round_has_few_tasks(spark):
    """A task of a round holds about a million (point, fit) pairs: its start cost more than the pairs of a tenth of that."""
    points = spark.range(1000).repartition(8).selectExpr("'base' AS space", "CAST(id AS STRING) AS customer_id", "id * 1D AS x", "0D AS y", "0D AS z")
    assert iteration_input(points, 90_000, 20).rdd.getNumPartitions() == 2


def test_boxes_change_the_work_and_no_result(spark, monkeypatch):
    """Most boxes of a laid-out cloud are settled as a whole, and labels are those of every point by itself: equal distances, centres in
    the middle of a box, points without a coordinate, fits of unequal width."""
    rng = np.random.default_rng(3)
    at = np.round(rng.normal(size=(20_000, 3)), 10)
    at[:500] = 0.0  # one place, half-way between the centres of the last fit
    bad = np.zeros(len(at), bool)
    bad[7000] = True
    order = nearest._kd_order(at)
    assert sorted(order.tolist()) == list(range(len(at)))
    sets = [[tuple(map(float, c)) for c in rng.normal(size=(k, 3))] for k in (1, 2, 3, 5, 8)] + [[(1.0, 0.0, 0.0), (-1.0, 0.0, 0.0)], [(0.0, 0.0, 0.0)] * 2]
    c, alone = Centres(sets), [Centres([s]) for s in sets]
    boxes = nearest._Boxes(at[order], bad[order])
    want = c.labels(at[order])
    want[bad[order]] = 0
    assert (boxes.labels(c, alone) == want).all()
    settled = boxes.settled(c)
    assert (settled[:, :5] >= 0).mean() > 0.5  # else nothing is saved
    assert (settled[boxes.odd] == -1).all() and (settled[:, 6] == -1).all()
    scattered = nearest._Boxes(at, bad)
    assert (scattered.labels(c, alone)[order] == want).all()


def test_points_laid_out_are_the_same_points(spark):
    _, some = cloud(spark, 3000)
    odd = [("b", None, 1.0, 2.0, 3.0), ("a", "gone", None, 1.0, 2.0), ("b", "twice", 1.0, 2.0, 3.0), ("b", "twice", 1.0, 2.0, 3.0)]
    points = some.unionByName(spark.createDataFrame(odd, SCHEMA)).repartition(5)
    for parts in (1, 4):
        laid = nearest.near_together(points, parts)
        assert laid.rdd.getNumPartitions() == parts
        assert sorted(map(str, laid.collect())) == sorted(map(str, points.collect()))


def test_fits_are_measured_where_the_points_are(spark):
    """Sizes, inertia and equal partitions without (point, fit) rows; label vectors hold distinct labelings only."""
    from shoplens.operators.sweeps import Batch

    rows = [("a", f"{i:03d}", float(i % 7), float(i % 5), 0.5) for i in range(300)] + [("a", None, 6.0, 6.0, 6.0), ("a", "gone", None, 1.0, 1.0), ("a", "far", 20000.0, 0.0, 0.0)]
    points = spark.createDataFrame(rows, SCHEMA).repartition(3)
    centres = [(0.0, 0.0, 0.0), (6.0, 4.0, 0.0), (3.0, 2.0, 1.0)]
    fits = [centres, centres[::-1], centres[:2], [(3.0, 2.0, 0.0)]]
    batch = Batch(points, {f: K.FitState(K.FitSpec(f, "a", len(c), f), c) for f, c in enumerate(fits)}, {"a": [0, 1, 2, 3]})
    batch.measure()
    held = K.assign(points, list(batch.states.values())).collect()
    for f, st in batch.states.items():
        # the point without a coordinate counts in the first cluster and adds no distance
        sizes = [sum(r.fit == f and r.label == j for r in held) for j in range(st.spec.k)]
        assert batch.sizes[f] == sizes and sum(sizes) == len(rows)
        assert batch.inertia[f] == pytest.approx(sum(r.d2 for r in held if r.fit == f and r.d2 is not None), rel=1e-13)
    assert batch.same_as[2] == 2 and batch.same_as[3] == 3
    assert batch.firsts["a"] == [f for f in range(4) if batch.same_as[f] == f]
    assert {len(r.labels) for r in batch.labelled.collect()} == {len(batch.firsts["a"])}
    plan = nearest.fit_stats(points, {"a": [(f, st.centres) for f, st in batch.states.items()]})._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Join" not in plan
