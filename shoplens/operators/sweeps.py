"""Model-selection and sensitivity workloads: units of fits, run when a query first needs them.

Every clustering input is a *space*: the baseline customers under each cap threshold, the customers of each line variant
(copies kept, product-like lines only, home country only), and the preprocessing alternatives. A *unit* is one (space, k)
with its seeds, or with the restarts of a representative model. A query names its units; those that no earlier query has run
advance together in one batch, one aggregate job per Lloyd round, over one checkpointed point table. Variant RFMs come from
one aggregate keyed by (variant, customer) over a union of the line sources, not one scan per variant.

**Distinct labelings.** Different seeds often end in the same partition under other cluster numbers. A cluster's signature is
(its least member, its size, two 64-bit checksums of its members); a fit's canonical form is the list of its clusters'
signatures by least member, from the same pass that gives sizes and inertia. Fits of a space with equal forms are one
labeling: it gets one silhouette and one ARI row, which count for all of its fits.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from decimal import Decimal
from functools import cached_property
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import country_display
from ..params import Params
from ..session import cut_lineage, materialize
from . import kmeans as K
from .evaluate import pairwise_ari, silhouettes
from .features import Caps, Scale, apply_scale, compute_scale, log_features, raw_features, robust_scale
from .model import as_points, iteration_input, prepare_customers
from .nearest import HALF, UNITS, fit_stats, label_vectors

BASE_SPACE = "cap995"
ROBUST, LOG = "robust", "log"  # uncapped: median and interquartile range; ln(1 + x) of customers with a positive net value
SEEDS, RESTARTS = "seeds", "restarts"


@dataclass(frozen=True)
class Unit:
    """The fits of one (space, k): every seed once, or the restarts of the model seed."""

    space: str
    k: int
    kind: str = SEEDS


@dataclass
class Space:
    customers: DataFrame
    caps: Caps
    scale: Scale
    count: int


@dataclass
class Batch:
    """Units that were fitted together: labels, and what the driver keeps of them (fits × k rows)."""

    points: DataFrame
    states: dict[int, K.FitState]
    order: dict[str, list[int]]  # space -> fits, the order of its label vectors
    sizes: dict[int, list[int]] = field(default_factory=dict)
    inertia: dict[int, float] = field(default_factory=dict)
    same_as: dict[int, int] = field(default_factory=dict)  # fit -> first fit with the same partition

    @cached_property
    def firsts(self) -> dict[str, list[int]]:
        """The fits of each space that are the first of their partition."""
        return {sp: [f for f in fl if self.same_as[f] == f] for sp, fl in self.order.items()}

    @cached_property
    def labelled(self) -> DataFrame:
        """(space, customer_id, x, y, z, labels) with labels aligned to ``firsts[space]``; checkpointed.

        Each point meets the centres of its space's distinct fits (bounded by fits × k) in place: label vectors need no shuffle of
        (point, fit) rows, and fits that are equal as partitions have one entry."""
        return cut_lineage(label_vectors(self.points, {sp: [self.states[f].centres for f in fl] for sp, fl in self.firsts.items()}, distances=False))

    def measure(self) -> None:
        """Sizes, inertia and canonical forms of all fits, from one pass over the points in which each task adds up its own."""
        clusters: dict[int, dict[int, tuple]] = {f: {} for f in self.states}
        exact: dict[int, Decimal] = dict.fromkeys(self.states, Decimal(0))
        for r in fit_stats(self.points, {sp: [(f, self.states[f].centres) for f in fl] for sp, fl in self.order.items()}).collect():
            if r["n"]:
                sums = [(int(r[f"{c}1"]) * 2**32 + int(r[f"{c}0"])) % 2**64 for c in "ab"]
                clusters[r["fit"]][r["l"]] = (r["least"] is not None, r["least"] or "", int(r["n"]), *sums)
            exact[r["fit"]] += Decimal(int(r["hi"]) * HALF + int(r["lo"])) / UNITS
        self.inertia = {f: float(v) for f, v in exact.items()}
        self.sizes = {f: [clusters[f][i][2] if i in clusters[f] else 0 for i in range(st.spec.k)] for f, st in self.states.items()}
        first: dict[tuple, int] = {}
        for sp, fits in self.order.items():
            for f in fits:
                self.same_as[f] = first.setdefault((sp, *sorted(clusters[f].values())), f)

    def distinct(self, fits: Iterable[int]) -> list[int]:
        return sorted({self.same_as[f] for f in fits})

    def vectors(self, fits: dict[str, list[int]]) -> DataFrame:
        """``labelled`` with the labels of some distinct fits of each space only."""
        spark = self.points.sparkSession
        at = spark.createDataFrame([(sp, [self.firsts[sp].index(f) for f in fl]) for sp, fl in fits.items()], "space string, at array<int>")
        return self.labelled.join(F.broadcast(at), "space").select(
            "space", "customer_id", "x", "y", "z", F.transform("at", lambda i: F.get("labels", i)).alias("labels"))


class Sweep:
    """Fits by unit, each run once; silhouettes and ARIs of distinct labelings."""

    def __init__(self, build):
        self.build = build
        self.params: Params = build.params
        self._spaces: dict[str, Space] = {}
        self._fits: dict[Unit, list[int]] = {}
        self._batch: dict[int, Batch] = {}
        self._silhouette: dict[int, float] = {}
        self._ari: dict[tuple[int, int], float] = {}

    # --- inputs
    @cached_property
    def variants(self) -> DataFrame:
        return variant_rfm(self.build)

    def space(self, name: str) -> Space:
        if name not in self._spaces:
            quantiles = dict(self.params.cap_specs)
            if name in quantiles:
                caps, scale, scaled = prepare_customers(self.build.rfm, quantiles[name])
            elif name in self.params.variants:
                mine = self.variants.where(F.col("variant") == name).drop("variant")
                caps, scale, scaled = prepare_customers(mine, self.params.cap_quantile)
            elif name == ROBUST:
                caps, scale = Caps(None, None, None), robust_scale(self.build.rfm)
                scaled = apply_scale(self.build.rfm, scale, raw_features())
            elif name == LOG:
                positive = self.build.rfm.where("net_monetary > 0")
                caps, scale = Caps(None, None, None), compute_scale(positive, log_features())
                scaled = apply_scale(positive, scale, log_features())
            else:
                raise KeyError(f"unknown space {name}")
            customers = materialize(scaled, f"space-{name}")
            self._spaces[name] = Space(customers, caps, scale, customers.count())
        return self._spaces[name]

    # --- fits
    def run(self, units: Sequence[Unit]) -> None:
        """Fit the units that are not there yet, all in one batch."""
        todo = [u for u in dict.fromkeys(units) if u not in self._fits]
        if not todo:
            return
        p, specs = self.params, []
        number = len(self._batch)
        for u in todo:
            wanted = [(s, 0) for s in p.seeds] if u.kind == SEEDS else [(p.seed, i) for i in range(p.n_init)]
            self._fits[u] = list(range(number, number + len(wanted)))
            specs.extend(K.FitSpec(number + n, u.space, u.k, s, i) for n, (s, i) in enumerate(wanted))
            number += len(wanted)
        names = list(dict.fromkeys(u.space for u in todo))
        points = None
        for name in names:
            part = as_points(self.space(name).customers, name)
            points = part if points is None else points.unionByName(part)
        work = sum(self.space(s.space).count for s in specs)
        points = cut_lineage(iteration_input(points, max(work // len(specs), 1), len(specs)))
        points.persist()  # in memory on top of the checkpoint while the rounds go on
        order: dict[str, list[int]] = {}
        for s in specs:
            order.setdefault(s.space, []).append(s.fit)
        batch = Batch(points, K.fit_many(points, specs, p.max_iter, tol=p.tol), order)
        batch.measure()
        points.unpersist()
        self._batch.update(dict.fromkeys(batch.states, batch))

    def fits(self, unit: Unit) -> list[int]:
        self.run([unit])
        return self._fits[unit]

    def state(self, fit: int) -> K.FitState:
        return self._batch[fit].states[fit]

    def inertia(self, fit: int) -> float:
        return self._batch[fit].inertia[fit]

    def sizes(self, fit: int) -> list[int]:
        return self._batch[fit].sizes[fit]

    def best(self, unit: Unit) -> K.FitState:
        """The restart with the least inertia; ties to the first."""
        return self.state(min(self.fits(unit), key=lambda f: (self.inertia(f), self.state(f).spec.init)))

    def labelings(self, unit: Unit) -> list[tuple[int, int]]:
        """Distinct labelings of a unit with the number of their fits."""
        fits = self.fits(unit)
        first = [self._batch[f].same_as[f] for f in fits]
        return [(f, first.count(f)) for f in dict.fromkeys(first)]

    # --- evaluation
    def _by_batch(self, fits: Iterable[int]) -> dict[int, tuple[Batch, list[int]]]:
        found: dict[int, tuple[Batch, list[int]]] = {}
        for f in fits:
            batch = self._batch[f]
            found.setdefault(id(batch), (batch, []))[1].append(f)
        return found

    def silhouettes(self, units: Sequence[Unit]) -> dict[int, float]:
        """Silhouette of every fit of the units: one computation for each distinct labeling."""
        self.run(units)
        return self.silhouettes_of([f for u in units for f in self._fits[u]])

    def silhouettes_of(self, fits: Sequence[int]) -> dict[int, float]:
        """Silhouette of some fits that have been run."""
        for batch, mine in self._by_batch(fits).values():
            todo = [f for f in batch.distinct(mine) if f not in self._silhouette]
            if todo:
                spaces: dict[str, list[int]] = {}
                for f in todo:
                    spaces.setdefault(batch.states[f].spec.space, []).append(f)
                rows = silhouettes(batch.vectors(spaces), {f: batch.sizes[f] for f in todo}, spaces).collect()
                self._silhouette.update({r["fit"]: r["silhouette"] for r in rows})
        return {f: self._silhouette[self._batch[f].same_as[f]] for f in fits}

    def aris(self, units: Sequence[Unit]) -> dict[Unit, list[tuple[int, int, float]]]:
        """(fit, fit, ARI) for every pair of fits of each unit; equal labelings agree fully, the others are compared once."""
        self.run(units)
        for batch, mine in self._by_batch(f for u in units for f in self._fits[u]).values():
            groups: dict[str, list] = {}
            spaces: dict[str, list[int]] = {}
            for u in units:
                if self._fits[u][0] not in mine:
                    continue
                firsts = batch.distinct(self._fits[u])
                if any(pair not in self._ari for pair in combinations(firsts, 2)):
                    held = spaces.setdefault(u.space, [])
                    groups.setdefault(u.space, []).append((f"{u.space}|{u.k}|{u.kind}", list(range(len(held), len(held) + len(firsts))), firsts))
                    held.extend(firsts)
            if groups:
                vectors = batch.vectors(spaces).select("space", "labels")
                self._ari.update({(r["fa"], r["fb"]): r["ari"] for r in pairwise_ari(vectors, groups).collect()})
        out = {}
        for u in units:
            same = self._batch[self._fits[u][0]].same_as
            pairs = []
            for a, b in combinations(self._fits[u], 2):
                x, y = sorted((same[a], same[b]))
                pairs.append((a, b, 1.0 if x == y else self._ari[x, y]))
            out[u] = pairs
        return out


def variant_lines(build) -> DataFrame:
    """Union of the line variants with a ``variant`` key (one scan per line source)."""
    p = build.params
    lines = build.lines
    wide = lambda df: df.withColumn("line_amount", F.col("line_amount").cast("decimal(38,4)"))
    product = wide(lines.where("is_product_like")).withColumn("variant", F.lit("product_like_only"))
    home = wide(lines.where(F.col("country") == p.home_country)).withColumn("variant", F.lit("home_country_only"))
    dupes = build.raw_known_lines.withColumn("variant", F.lit("duplicates_kept"))
    return dupes.unionByName(product).unionByName(home)


def variant_rfm(build) -> DataFrame:
    """RFM per (variant, customer) in one aggregate, checkpointed (customer-sized)."""
    v = variant_lines(build)
    valid = F.col("is_valid_positive_purchase")
    agg = v.groupBy("variant", "customer_id").agg(
        F.max(F.when(valid, F.to_date("invoice_date"))).alias("last_purchase"),
        F.count_distinct(F.when(valid, F.col("invoice_no"))).alias("frequency"),
        F.sum(F.when(valid, F.col("line_amount"))).alias("gross_monetary"),
        F.sum("line_amount").alias("net_monetary"),
        country_display(F.col("country")).alias("country_display"),
        F.max(valid).alias("_has_valid"),
    )
    out = agg.where("_has_valid").select(
        "variant",
        "customer_id",
        "country_display",
        "last_purchase",
        F.datediff(F.lit(build.params.reference_date).cast("date"), F.col("last_purchase")).cast("bigint").alias("recency"),
        F.col("frequency").cast("bigint").alias("frequency"),
        "gross_monetary",
        "net_monetary",
    )
    return materialize(out, "variant_rfm")
