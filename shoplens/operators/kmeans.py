"""K-means as DataFrame jobs: seeded k-means++ start and Lloyd rounds for many fits at once.

Data layout
-----------
``points``: (space, customer_id, x, y, z). A *space* is one clustering input (a cap
threshold, a line variant); several spaces share one table. ``specs``: one row per fit
(fit, space, k, seed, init). Centres of all active fits travel as a small inline table (one
row per fit, k centres as columns), broadcast and equi-joined on ``space``; its size is
bounded by the number of fits × k, which the caller fixes, never by the data.

One Lloyd round is one job (``nearest.round_sums``): every point meets the centres of its
space's fits as one distance matrix per slice of an Arrow batch, ties go to the lower label,
each task adds up its own points, and an aggregate returns fits × k rows to the driver.
Settled fits drop out of later rounds. Coordinates are summed as DECIMAL, so centres are
exact and do not depend on partitioning or row order.

A fit is settled *strictly* when no centre moves any more, or within *tolerance* when the squared shifts of all its centres
add up to at most ``tol`` × the mean population variance of its space's coordinates. Labels always come from one closing
assignment to the final centres, so a fit that stopped on tolerance is as consistent as one that stopped strictly.

Seeded start
------------
For seed s, init i, step j and customer c, u = (h + 0.5) / 2^52 with h the first 13 hex of
md5("s|i|j|c") (52 bits: all that a double holds next to the half). The pick of step j is the point with the smallest −ln(u)/D² (D² = squared
distance to the nearest centre picked so far, 1 at step 0), ties to the lower customer id:
an exponential race, i.e. an exact D²-proportional draw that no partitioning can change.
"""

from __future__ import annotations

import itertools
import math
import warnings
from collections.abc import Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import dec_to_double
from ..params import DISTANCE_DIGITS
from .nearest import centre, label_steps, round_sums, seed_picks

Centre = tuple[float, float, float]
COORD_DEC = "decimal(18,10)"
D2_DEC = "decimal(20,10)"

@dataclass(frozen=True)
class FitSpec:
    fit: int
    space: str
    k: int
    seed: int
    init: int = 0


@dataclass
class FitState:
    spec: FitSpec
    centres: list[Centre]
    initial: list[Centre] = field(default_factory=list)
    picks: list[str] = field(default_factory=list)
    iterations: int = 0
    settled: str = ""  # "strict", "tolerance", or empty while the fit is open
    empty_rounds: list[int] = field(default_factory=list)  # rounds in which a cluster had no member
    history: list[list[Centre]] | None = None  # centres after each round, kept on request


class EmptyCluster(ValueError):
    """A fit lost a cluster. Other fits of its batch go on; it is raised where this fit is asked for."""


class UnstableTrace(ValueError):
    """A trace ended, at its round limit, before two rounds had the same labels."""


_FITS = itertools.count()


def fits_frame(
    spark: SparkSession, states: Sequence[FitState], previous: dict[int, list[Centre]] | None = None
) -> tuple[DataFrame, int]:
    """The active fits as a small table, one row per fit: (fit, fspace, seed, init, k,
    c{j}_x/y/z..., p{j}_x/y/z...), centres beyond a fit's own count padded with 0 and
    masked by ``k``. Its size is fits × k, fixed by the caller, never by the data. It is
    built from Arrow batches (exact doubles), so a round needs no large SQL text."""
    kmax = max([len(st.centres) for st in states] + [len(v) for v in (previous or {}).values()] + [1])
    cols: dict[str, list] = {"fit": [], "fspace": [], "seed": [], "init": [], "k": []}
    for j in range(kmax):
        for a in "xyz":
            cols[f"c{j}_{a}"] = []
    if previous is not None:
        for j in range(kmax):
            for a in "xyz":
                cols[f"p{j}_{a}"] = []
    for st in states:
        cols["fit"].append(st.spec.fit)
        cols["fspace"].append(st.spec.space)
        cols["seed"].append(st.spec.seed)
        cols["init"].append(st.spec.init)
        cols["k"].append(len(st.centres))
        for j in range(kmax):
            c = st.centres[j] if j < len(st.centres) else (0.0, 0.0, 0.0)
            for a, v in zip("xyz", c, strict=True):
                cols[f"c{j}_{a}"].append(float(v))
        if previous is not None:
            prev = previous.get(st.spec.fit, [])
            for j in range(kmax):
                c = prev[j] if j < len(prev) else (0.0, 0.0, 0.0)
                for a, v in zip("xyz", c, strict=True):
                    cols[f"p{j}_{a}"].append(float(v))
    pdf = pd.DataFrame(cols)
    schema = ", ".join(
        f"{n} {'string' if n == 'fspace' else ('int' if n in ('fit', 'seed', 'init', 'k') else 'double')}" for n in pdf.columns
    )
    return spark.createDataFrame(pdf, schema), kmax


def fits_view(spark: SparkSession, states: Sequence[FitState], previous: dict[int, list[Centre]] | None = None) -> tuple[str, int]:
    """A temp view of the fit table, dropped by the caller after its round."""
    df, kmax = fits_frame(spark, states, previous)
    name = f"shoplens_fits_{next(_FITS)}"
    df.createOrReplaceTempView(name)
    return name, kmax


def with_fits(points: DataFrame, states: Sequence[FitState], previous: dict[int, list[Centre]] | None = None) -> tuple[DataFrame, int]:
    """Every point next to each fit of its space (equi-join on the space, fits broadcast)."""
    fits, kmax = fits_frame(points.sparkSession, states, previous)
    paired = points.join(F.broadcast(fits), points["space"] == fits["fspace"]).drop("fspace")
    return paired, kmax


_VIEWS = itertools.count()


def points_view(points: DataFrame) -> str:
    """A session temp view over the iteration input, registered once per input."""
    name = getattr(points, "_shoplens_view", None)
    if name is None:
        name = f"shoplens_points_{next(_VIEWS)}"
        points.createOrReplaceTempView(name)
        points._shoplens_view = name
    return name


def _d2_text(prefix: str, j: int) -> str:
    t = " + ".join(f"({a} - {prefix}{j}_{a}) * ({a} - {prefix}{j}_{a})" for a in "xyz")
    return f"round({t}, {DISTANCE_DIGITS})"


def nearest_text(kmax: int, prefix: str = "c") -> str:
    """(d2, l) struct of the nearest centre: ``array_min`` over (distance, label) structs, so ties go to the lower label;
    missing centres (k < kmax) are null elements and skipped. Plain element expressions keep a round in generated code."""
    elems = ", ".join(
        f"CASE WHEN {j} < k THEN named_struct('d2', {_d2_text(prefix, j)}, 'l', {j}) END"
        for j in range(kmax)
    )
    return f"array_min(array({elems}))"


def min_d2_text(kmax: int) -> str:
    terms = [f"CASE WHEN {j} < k THEN {_d2_text('c', j)} END" for j in range(kmax)]
    return terms[0] if len(terms) == 1 else f"least({', '.join(terms)})"


def draw_text(step: int) -> str:
    key = f"concat_ws('|', CAST(seed AS STRING), CAST(init AS STRING), '{step}', customer_id)"
    return f"((CAST(conv(substring(md5({key}), 1, 13), 16, 10) AS DOUBLE) + 0.5D) / 4503599627370496.0D)"


def round_sql(view: str, values: str, kmax: int, with_changes: bool = False) -> str:
    """One Lloyd round as a single statement: nearest centre per (fit, point), then exact
    decimal sums per (fit, cluster). Map-side partial aggregation keeps the shuffle at
    (tasks × fits × k) rows."""
    prev = f", {nearest_text(kmax, 'p')} AS pb" if with_changes else ""
    changed = ", count(CASE WHEN pb.l <> b.l THEN 1 END) AS changed" if with_changes else ""
    mean = lambda a: f"CAST(CAST(sum(CAST({a} AS {COORD_DEC})) AS STRING) AS DOUBLE) / count(1)"
    return f"""
        SELECT fit, b.l AS l, count(1) AS n, {mean('x')} AS x, {mean('y')} AS y, {mean('z')} AS z,
               sum(CAST(b.d2 AS {D2_DEC})) AS inertia{changed}
        FROM (SELECT /*+ BROADCAST(t) */ fit, x, y, z, {nearest_text(kmax)} AS b{prev}
              FROM {view} JOIN {values} t ON space = fspace)
        GROUP BY fit, b.l"""


def seed_sql(view: str, values: str, kmax: int, step: int) -> str:
    """Score of every (fit, point) in a step of the seeded start."""
    if step == 0:
        score = f"-ln({draw_text(step)})"
    else:
        d2 = min_d2_text(kmax)
        score = f"CASE WHEN {d2} > 0 THEN -ln({draw_text(step)}) / {d2} ELSE CAST('Infinity' AS DOUBLE) END"
    return f"""
        SELECT /*+ BROADCAST(t) */ fit, {score} AS s, customer_id, x, y, z FROM {view} JOIN {values} t ON space = fspace"""


def seed_centres(points: DataFrame, specs: Sequence[FitSpec]) -> dict[int, FitState]:
    """k-means++ start for every fit; one aggregate job per step (k jobs for the largest k).

    A pick depends on the space, the seed, the init and the picks before it, not on k: fits that differ in k only share one start,
    drawn for the largest of them."""
    states = {s.fit: FitState(s, []) for s in specs}
    starts: dict[tuple, FitState] = {}
    for st in states.values():
        key = (st.spec.space, st.spec.seed, st.spec.init)
        if key not in starts or st.spec.k > starts[key].spec.k:
            starts[key] = st
    for step in range(max(s.k for s in specs)):
        active = [st for st in starts.values() if len(st.centres) < st.spec.k and step == len(st.centres)]
        if not active:
            break
        fits: dict[str, list] = {}
        for st in active:
            fits.setdefault(st.spec.space, []).append((st.spec.fit, st.spec.seed, st.spec.init, list(st.centres)))
        for r in seed_picks(points, fits, step).collect():
            st = states[r["fit"]]
            p = r["p"]
            st.centres.append((p["x"], p["y"], p["z"]))
            st.picks.append(p["customer_id"])
    for st in states.values():
        start = starts[st.spec.space, st.spec.seed, st.spec.init]
        st.centres, st.picks = start.centres[:st.spec.k], start.picks[:st.spec.k]
        st.initial = list(st.centres)
    return states


def one_round(points: DataFrame, states: Sequence[FitState]) -> DataFrame:
    """One assignment + recentring round: (fit, l, n, x, y, z, inertia)."""
    values, kmax = fits_view(points.sparkSession, states)
    return points.sparkSession.sql(round_sql(points_view(points), values, kmax))


def centres_by_space(states: Sequence[FitState]) -> dict[str, list[tuple[int, list[Centre]]]]:
    found: dict[str, list[tuple[int, list[Centre]]]] = {}
    for st in states:
        found.setdefault(st.spec.space, []).append((st.spec.fit, list(st.centres)))
    return found


def tolerances(points: DataFrame, tol: float) -> dict[str, float]:
    """``tol`` × the mean population variance of the coordinates, for each space (exact decimal sums)."""
    square = lambda a: F.sum((F.col(a).cast("decimal(18,10)") * F.col(a).cast("decimal(18,10)")).cast("decimal(28,15)"))
    rows = points.groupBy("space").agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col(a).cast(COORD_DEC)).alias(f"s{a}") for a in "xyz"],
                                       *[square(a).alias(f"q{a}") for a in "xyz"]).collect()
    return {r["space"]: tol * sum(max(0.0, float(r[f"q{a}"]) / r["n"] - (float(r[f"s{a}"]) / r["n"]) ** 2) for a in "xyz") / 3 for r in rows}


def run_lloyd(points: DataFrame, states: dict[int, FitState], max_iter: int, tol: dict[str, float] | None = None) -> dict[int, FitState]:
    """Lloyd rounds until every fit is settled or has ``max_iter`` rounds behind it; without ``tol`` only strictly settled fits
    end early.

    An empty cluster keeps its previous centre and the fit notes the round. Fits that have not settled say so: their
    ``settled`` stays empty and a warning names them.
    """
    while True:
        active = [st for st in states.values() if not st.settled and st.iterations < max_iter]
        if not active:
            break
        new: dict[int, dict[int, Centre]] = {}
        for r in round_sums(points, centres_by_space(active)).collect():
            new.setdefault(r["fit"], {})[r["l"]] = centre(r)
        for st in active:
            got = new.get(st.spec.fit, {})
            updated = [got.get(i, c) for i, c in enumerate(st.centres)]
            st.iterations += 1
            if len(got) < len(st.centres):
                st.empty_rounds.append(st.iterations)
            shift = sum((a - b) * (a - b) for u, c in zip(updated, st.centres, strict=True) for a, b in zip(u, c, strict=True))
            if updated == st.centres:
                st.settled = "strict"
            elif tol is not None and shift <= tol[st.spec.space]:
                st.settled = "tolerance"
            st.centres = updated
            if st.history is not None:
                st.history.append(list(updated))
    open_fits = [st.spec.fit for st in states.values() if not st.settled]
    if open_fits:
        warnings.warn(f"fits {open_fits} have not settled in {max_iter} rounds", stacklevel=2)
    return states


def assign(points: DataFrame, states: Sequence[FitState]) -> DataFrame:
    """Nearest final centre per (fit, customer): (fit, space, customer_id, x, y, z, label, d2)."""
    paired, kmax = with_fits(points, list(states))
    return paired.select(
        "fit",
        "space",
        "customer_id",
        "x",
        "y",
        "z",
        F.expr(nearest_text(kmax)).alias("b"),
    ).select(
        "fit", "space", "customer_id", "x", "y", "z", F.col("b.l").alias("label"), F.col("b.d2").alias("d2")
    )


def inertia_table(assigned: DataFrame) -> DataFrame:
    """Per fit: Σ squared distance to the own centre (exact decimal sum), cluster sizes."""
    return assigned.groupBy("fit").agg(
        F.sum(F.col("d2").cast(D2_DEC)).alias("inertia"),
        F.count(F.lit(1)).alias("n"),
    )


def fit_many(points: DataFrame, specs: Sequence[FitSpec], max_iter: int, keep_history: Sequence[int] = (), tol: float = 0.0) -> dict[int, FitState]:
    states = seed_centres(points, specs)
    for f in keep_history:
        states[f].history = [list(states[f].initial)]
    return run_lloyd(points, states, max_iter, tolerances(points, tol) if tol > 0 else None)


def best_of(points: DataFrame, states: dict[int, FitState], groups: dict[int, list[int]]) -> dict[int, FitState]:
    """Per group of fits (restarts of one model), the fit with the lowest inertia; ties → lowest init."""
    assigned = assign(points, [states[f] for fits in groups.values() for f in fits])
    inertia = {r["fit"]: r["inertia"] for r in inertia_table(assigned).collect()}
    out = {}
    for g, fits in groups.items():
        out[g] = min((states[f] for f in fits), key=lambda st: (inertia[st.spec.fit], st.spec.init))
    return out


def trace_history(points: DataFrame, state: FitState, max_iter: int) -> list[list[Centre]]:
    """Centres of one fit from its seeded start to its strict end. A fit that stopped on tolerance goes on from where it
    stood; the fit itself keeps its centres."""
    if state.history is not None and state.settled == "strict":
        return state.history
    kept = state.history if state.history is not None else [list(state.initial)]
    st = FitState(state.spec, list(kept[-1]), history=list(kept), iterations=len(kept) - 1)
    return run_lloyd(points, {state.spec.fit: st}, max_iter)[state.spec.fit].history


def trace(points: DataFrame, state: FitState, max_iter: int) -> list[dict]:
    """Lloyd trace of one fit from its seeded start: per iteration the centres before and
    after, cluster sizes, changed-label count (0 in the first round) and the largest centre
    shift; it stops at the first round whose labels equal the previous round's.

    Every frame is recomputed from the centre history in ONE job: frame i is a pseudo-fit with
    centres c(i−1) that follows frame i−1, and a single batched round gives its sizes, new
    centres and changed-label count. Raises ``EmptyCluster`` for a frame that lost a
    cluster, ``UnstableTrace`` where the round limit came first."""
    hist = trace_history(points, state, max_iter)
    n_frames = min(len(hist), max_iter)  # frames 1..T+1 (T rounds kept, plus the stable one)
    frames_states = [FitState(FitSpec(i, state.spec.space, state.spec.k, state.spec.seed, state.spec.init), list(hist[i - 1])) for i in range(1, n_frames + 1)]
    rows = round_sums(points, centres_by_space(frames_states), {i: max(1, i - 1) for i in range(1, n_frames + 1)}).collect()
    by: dict[int, dict[int, object]] = {}
    for r in rows:
        by.setdefault(r["fit"], {})[r["l"]] = r
    frames = []
    for st in frames_states:
        i = st.spec.fit
        centres = st.centres
        got = by.get(i, {})
        if len(got) < len(centres):
            raise EmptyCluster(f"fit {state.spec} has no member in cluster {sorted(set(range(len(centres))) - set(got))} of frame {i}")
        updated = [centre(got[j]) for j in range(len(centres))]
        changed = sum(int(r["changed"]) for r in got.values()) if i >= 2 else 0
        shift = max(math.sqrt(sum((a - b) * (a - b) for a, b in zip(u, c, strict=True))) for u, c in zip(updated, centres, strict=True))
        frames.append(
            {
                "iteration": i,
                "centres_before": centres,
                "centres_after": updated,
                "sizes": [int(got[j]["n"]) for j in range(len(centres))],
                "changed_count": changed,
                "max_centroid_shift": shift,
            }
        )
        if i >= 2 and changed == 0:
            return frames
    raise UnstableTrace(f"fit {state.spec} still changes labels in frame {n_frames}")


def label_changes(points: DataFrame, frames: Sequence[dict]) -> DataFrame:
    """(iteration, customer_id, label_before, label_after) of every point whose label changed between neighbouring frames.

    One scan: a point's labels of all frames come from one distance matrix per slice of points, neighbours are compared inside it,
    and only the changes leave the task."""
    space = points.select("space").first()
    if space is None:
        return points.select(F.lit(0).cast("bigint").alias("iteration"), "customer_id", F.lit(0).cast("bigint").alias("label_before"), F.lit(0).cast("bigint").alias("label_after"))
    steps = label_steps(points, space["space"], [f["centres_before"] for f in frames])
    return steps.select((F.col("step") + 1).alias("iteration"), "customer_id", "label_before", "label_after")
