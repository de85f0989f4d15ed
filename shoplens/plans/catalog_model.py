"""Registered queries on the fitted model: features, start, trace, segments, serving pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.numeric import dec_to_double
from ..functions.output import dbl, decimal_round, money_out, quantile_out, timestamp_text
from ..operators import kmeans as K
from ..operators import serving as S
from ..operators.features import non_finite_count
from ..operators.lines import running_ranks
from ..operators.model import XYZ, labels_for
from ..operators.quantiles import exact_quantiles
from ..operators.segments import PROFILE_METRICS, adjusted_rand, mapping_frame
from .build import Build


def _b(spark: SparkSession, sf_dir: str) -> Build:
    return Build.of(spark, sf_dir)


def _one(df: DataFrame) -> DataFrame:
    return df.withColumn("_one", F.lit(1))


# ---------------------------------------------------------------- features
def feature_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Caps at the exact 99.5 % quantile and the customers they affect."""
    b = _b(spark, sf_dir)
    m = b.model
    return m.customers.agg(
        F.lit(m.caps.quantile).cast("double").alias("cap_quantile"),
        quantile_out(F.lit(m.caps.frequency_cap)).alias("frequency_cap"),
        quantile_out(F.lit(m.caps.net_monetary_cap)).alias("net_monetary_cap"),
        F.count(F.when(F.col("frequency_capped_flag"), 1)).cast("bigint").alias("frequency_capped_customers"),
        F.count(F.when(F.col("monetary_capped_flag"), 1)).cast("bigint").alias("monetary_capped_customers"),
        F.count(F.when(F.col("any_capped_flag"), 1)).cast("bigint").alias("either_affected"),
    )


def rfm_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upper-clipped F and net with the capped flags."""
    c = _b(spark, sf_dir).model.customers
    return c.select(
        "customer_id",
        quantile_out(F.col("frequency_capped")).alias("frequency_capped"),
        quantile_out(F.col("net_monetary_capped")).alias("net_monetary_capped"),
        "frequency_capped_flag",
        "monetary_capped_flag",
        "any_capped_flag",
    )


def rfm_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Population z-scores of recency, capped F, capped net."""
    c = _b(spark, sf_dir).model.customers
    return c.select("customer_id", *XYZ)


def feature_finite_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the model input with NaN, ±inf or null (K7); must be 0."""
    c = _b(spark, sf_dir).model.customers
    return non_finite_count(c, XYZ)


# ---------------------------------------------------------------- seeded start and Lloyd
def kpp_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k-means++ step table of the first restart: per step and customer the squared distance
    to the nearest chosen centre, its selection probability D²/ΣD², the display intensity
    clipped at the 99.5 % quantile of positive D², and the pick (I4, F9)."""
    b = _b(spark, sf_dir)
    st = b.model.states[0]
    points = b.model.points
    steps = [K.FitState(K.FitSpec(j, st.spec.space, st.spec.k, st.spec.seed, st.spec.init), st.initial[:j]) for j in range(1, st.spec.k)]
    paired, kmax = K.with_fits(points, steps)
    d = paired.select(F.col("fit").alias("step"), "customer_id", F.expr(K.min_d2_text(kmax)).alias("d2"))
    totals = d.groupBy("step").agg(dec_to_double(F.sum(F.col("d2").cast(K.D2_DEC))).alias("total"))
    caps = exact_quantiles(d.where(F.col("d2") > 0), ["step"], "d2", [0.995]).select("step", F.col("q").alias("cap"))
    picks = spark.createDataFrame([(j, pid) for j, pid in enumerate(st.picks)], "step int, pick_id string")
    later = (
        d.join(F.broadcast(totals), "step")
        .join(F.broadcast(caps), "step", "left")
        .join(F.broadcast(picks), "step")
        .select(
            (F.col("step") + 1).cast("bigint").alias("center_number"),
            "customer_id",
            "d2",
            (F.col("d2") / F.col("total")).alias("probability"),
            dbl(F.least(F.greatest(F.col("d2") / F.col("cap"), F.lit(0.0)), F.lit(1.0))).alias("display_intensity"),
            (F.col("customer_id") == F.col("pick_id")).alias("is_selected"),
        )
    )
    first = points.select(
        F.lit(1).cast("bigint").alias("center_number"),
        "customer_id",
        F.lit(None).cast("double").alias("d2"),
        F.lit(None).cast("double").alias("probability"),
        F.lit(0.0).alias("display_intensity"),
        (F.col("customer_id") == F.lit(st.picks[0])).alias("is_selected"),
    )
    return first.unionByName(later)


def assign_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's nearest k-means++ start centre, ties to the lower label."""
    b = _b(spark, sf_dir)
    st = b.model.states[0]
    label, dist = labels_for(st.initial)
    from ..functions.numeric import nearest_centre

    _, d2 = nearest_centre([F.col(c) for c in XYZ], st.initial)
    return b.model.customers.select(
        "customer_id", label.alias("label"), d2.alias("d2"), dist.alias("distance")
    )


def lloyd_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One Lloyd round from the k-means++ start: cluster sizes, new centres, inertia."""
    b = _b(spark, sf_dir)
    st = b.model.states[0]
    start = K.FitState(st.spec, list(st.initial))
    r = K.one_round(b.model.points, [start])
    return r.select(
        F.col("l").cast("bigint").alias("label"),
        F.col("n").cast("bigint").alias("size"),
        "x",
        "y",
        "z",
        dec_to_double(F.col("inertia")).alias("inertia"),
    )


def lloyd_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Lloyd trace of the first restart, one row per (iteration, cluster)."""
    frames = _b(spark, sf_dir).trace
    rows = []
    for f in frames:
        for label, (bc, ac) in enumerate(zip(f["centres_before"], f["centres_after"], strict=True)):
            rows.append((f["iteration"], label, f["sizes"][label], *bc, *ac, f["changed_count"], f["max_centroid_shift"]))
    df = spark.createDataFrame(
        rows,
        "iteration long, label long, size long, before_x double, before_y double, before_z double, "
        "after_x double, after_y double, after_z double, changed_count long, max_centroid_shift double",
    )
    return df.select(
        "iteration",
        "label",
        "size",
        "before_x",
        "before_y",
        "before_z",
        "after_x",
        "after_y",
        "after_z",
        "changed_count",
        dbl(F.col("max_centroid_shift")).alias("max_centroid_shift"),
    )


def lloyd_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers whose label changed, for every round of the first restart's trace."""
    b = _b(spark, sf_dir)
    return K.label_changes(b.model.points, b.trace)


# ---------------------------------------------------------------- segments
def semantic_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw cluster → segment by median raw net value, with the medians and sizes."""
    b = _b(spark, sf_dir)
    seg = b.segmented
    med = exact_quantiles(seg, ["raw_cluster"], "net_monetary", [0.5]).select(
        F.col("raw_cluster").cast("int").alias("raw_cluster"), F.col("q").alias("median_net_monetary")
    )
    sizes = seg.groupBy(F.col("raw_cluster").cast("int").alias("raw_cluster")).agg(F.count(F.lit(1)).alias("customers"))
    return (
        mapping_frame(spark, b.model.mapping)
        .join(med, "raw_cluster")
        .join(sizes, "raw_cluster")
        .select(
            F.col("raw_cluster").cast("bigint").alias("raw_cluster"),
            "segment_code",
            F.col("segment_order").cast("bigint").alias("segment_order"),
            quantile_out(F.col("median_net_monetary")).alias("median_net_monetary"),
            F.col("customers").cast("bigint").alias("customers"),
        )
    )


def majority_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The traced run's clusters named by their majority final segment, with agreement, the ARI between the traced labels
    and the final segments, and whether the naming is one to one (E22, I12). ``segments.require_one_to_one`` raises on it."""
    b = _b(spark, sf_dir)
    final = b.trace[-1]["centres_before"]
    label, _ = labels_for(final)
    pairs = b.segmented.select("customer_id", label.alias("trace_label"), "segment_code")
    counts = pairs.groupBy("trace_label", "segment_code").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("trace_label").orderBy(F.desc("n"), "segment_code")
    best = (
        counts.withColumn("rk", F.row_number().over(w))
        .withColumn("members", F.sum("n").over(Window.partitionBy("trace_label")))
        .where("rk = 1")
    )
    ari = adjusted_rand(pairs, "trace_label", "segment_code")
    whole = best.agg(((F.count_distinct("segment_code") == b.params.k) & (F.count(F.lit(1)) == b.params.k)).alias("one_to_one"))
    return _one(best).join(F.broadcast(_one(ari)), "_one").join(F.broadcast(_one(whole)), "_one").select(
        F.col("trace_label").cast("bigint").alias("raw_cluster"),
        "segment_code",
        F.col("members").cast("bigint").alias("members"),
        F.col("n").cast("bigint").alias("agreeing"),
        dbl(F.col("ari")).alias("ari_vs_final"),
        "one_to_one",
    )


def segment_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segment profiles in original units."""
    p = _b(spark, sf_dir).profiles
    cols = [
        "segment_code",
        F.col("segment_order").cast("bigint").alias("segment_order"),
        "segment_name",
        "description",
        "strategy_hypothesis",
        "future_kpis",
        "customers",
        dbl(F.col("customer_share")).alias("customer_share"),
        money_out(F.col("net_monetary_total")).alias("net_monetary_total"),
        dbl(F.col("net_monetary_share")).alias("net_monetary_share"),
    ]
    for m in PROFILE_METRICS:
        for n in ("mean", "q25", "median", "q75"):
            out = dbl if n == "mean" else quantile_out
            cols.append(out(F.col(f"{m}_{n}")).alias(f"{m}_{n}"))
    return p.select(*cols)


def cluster_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final centres in scaled units, named by segment."""
    b = _b(spark, sf_dir)
    m = b.model
    rows = [(m.mapping[i], i, *c) for i, c in enumerate(m.centres)]
    df = spark.createDataFrame(rows, "segment_code string, raw_cluster long, x double, y double, z double")
    return df.select(
        "segment_code",
        "raw_cluster",
        F.col("x").alias("scaled_recency"),
        F.col("y").alias("scaled_frequency"),
        F.col("z").alias("scaled_net_monetary"),
    )


def segment_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers per segment."""
    seg = _b(spark, sf_dir).segmented
    return seg.groupBy("segment_code").agg(F.count(F.lit(1)).cast("bigint").alias("customers"))


def representatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer nearest to each segment centre."""
    seg = _b(spark, sf_dir).segmented
    return seg.where("is_representative").select(
        "segment_code", "customer_id", "centroid_distance"
    )


def findings_high_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers, customer share and net share of the two top segments."""
    b = _b(spark, sf_dir)
    k = b.params.k
    top = [f"S{k - 1}", f"S{k}"]
    p = b.profiles
    return p.agg(
        F.sum(F.when(F.col("segment_code").isin(top), F.col("customers"))).cast("bigint").alias("top_customers"),
        dbl(F.sum(F.when(F.col("segment_code").isin(top), F.col("customer_share")))).alias("top_customer_share"),
        dbl(F.sum(F.when(F.col("segment_code").isin(top), F.col("net_monetary_share")))).alias("top_net_share"),
        money_out(F.sum("net_monetary_total")).alias("clustered_net_total"),
    )


def overview_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer and net shares per segment in percent, long form."""
    p = _b(spark, sf_dir).profiles
    return p.select(
        "segment_code",
        "segment_name",
        F.inline(
            F.array(
                F.struct(F.lit("customers").alias("measure"), F.col("customer_share").alias("share")),
                F.struct(F.lit("net_monetary").alias("measure"), F.col("net_monetary_share").alias("share")),
            )
        ),
    ).select("segment_code", "segment_name", "measure", dbl(F.col("share") * 100.0).alias("share_percent"))


def monotone_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Medians along S1..Sk: recency must not rise, frequency and net must not fall."""
    p = _b(spark, sf_dir).profiles.where(F.col("customers") > 0)
    w = Window.orderBy("segment_order")
    steps = p.select(
        "segment_code",
        "segment_order",
        "recency_median",
        "frequency_median",
        "net_monetary_median",
        F.coalesce(F.col("recency_median") <= F.lag("recency_median").over(w), F.lit(True)).alias("r_ok"),
        F.coalesce(F.col("frequency_median") >= F.lag("frequency_median").over(w), F.lit(True)).alias("f_ok"),
        F.coalesce(F.col("net_monetary_median") >= F.lag("net_monetary_median").over(w), F.lit(True)).alias("m_ok"),
    )
    return steps.select(
        "segment_code",
        F.col("segment_order").cast("bigint").alias("segment_order"),
        quantile_out(F.col("recency_median")).alias("recency_median"),
        quantile_out(F.col("frequency_median")).alias("frequency_median"),
        quantile_out(F.col("net_monetary_median")).alias("net_monetary_median"),
        "r_ok",
        "f_ok",
        "m_ok",
        F.min((F.col("r_ok") & F.col("f_ok") & F.col("m_ok")).cast("int")).over(Window.partitionBy()).cast("boolean").alias("ordering"),
    )


# ---------------------------------------------------------------- customer facts
def long_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median, 99.5 % quantile and maximum of frequency and net over clustered customers."""
    rfm = _b(spark, sf_dir).rfm
    long = rfm.select(
        F.inline(
            F.array(
                F.struct(F.lit("frequency").alias("metric"), F.col("frequency").cast("double").alias("v")),
                F.struct(F.lit("net_monetary").alias("metric"), dec_to_double(F.col("net_monetary")).alias("v")),
            )
        )
    )
    q = exact_quantiles(long, ["metric"], "v", [0.5, 0.995])
    mx = long.groupBy("metric").agg(F.max("v").alias("maximum"))
    wide = q.groupBy("metric").agg(
        F.max(F.when(F.col("p") == 0.5, F.col("q"))).alias("median"),
        F.max(F.when(F.col("p") == 0.995, F.col("q"))).alias("q995"),
    )
    return wide.join(mx, "metric").select(
        "metric", quantile_out(F.col("median")).alias("median"), quantile_out(F.col("q995")).alias("q995"), "maximum"
    )


def gross_net_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gross minus net (refunds) of every customer, ranked by the gap, ties by customer id.

    Ranks are running counts over range partitions, so no task holds all customers."""
    rfm = _b(spark, sf_dir).rfm
    gap = F.col("gross_monetary") - F.col("net_monetary")
    rows = rfm.select("customer_id", "gross_monetary", "net_monetary", gap.alias("gap"), (-gap).alias("_down"))
    ranked = running_ranks(rows, ["_down", "customer_id"], {"rank": F.lit(1)}, {"rank": 1})
    return ranked.select(
        F.col("rank").cast("bigint").alias("rank"),
        "customer_id",
        money_out(F.col("gross_monetary")).alias("gross_monetary"),
        money_out(F.col("net_monetary")).alias("net_monetary"),
        money_out(F.col("gap")).alias("gap"),
    )


def line_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known lines → valid positive lines → customers → cap-affected customers."""
    b = _b(spark, sf_dir)
    lines = b.lines.agg(
        F.count(F.lit(1)).cast("bigint").alias("known_transaction_lines"),
        F.count(F.when(F.col("is_valid_positive_purchase"), 1)).cast("bigint").alias("valid_positive_lines"),
    )
    cust = b.model.customers.agg(
        F.count(F.lit(1)).cast("bigint").alias("customers"),
        F.count(F.when(F.col("any_capped_flag"), 1)).cast("bigint").alias("cap_affected_customers"),
    )
    return _one(lines).join(_one(cust), "_one").drop("_one")


def invoice_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The invoice timeline view over all known lines."""
    t = _b(spark, sf_dir).timeline
    return t.select(
        "customer_id",
        "invoice_no",
        timestamp_text(F.col("invoice_date")).alias("invoice_date"),
        money_out(F.col("invoice_amount")).alias("invoice_amount"),
        F.col("line_count").cast("bigint").alias("line_count"),
        "is_cancellation",
        "has_valid_positive_line",
        F.when(F.col("is_cancellation"), F.lit("cancellation"))
        .when(F.col("invoice_amount") >= 0, F.lit("purchase"))
        .otherwise(F.lit("negative_other"))
        .alias("entry_class"),
    )


def customer_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timeline of the top segment's representative, by time then invoice."""
    b = _b(spark, sf_dir)
    t = S.customer_timeline(b.lines, b.demo_customer)
    return t.select(
        "customer_id",
        "invoice_no",
        timestamp_text(F.col("invoice_date")).alias("invoice_date"),
        money_out(F.col("invoice_amount")).alias("invoice_amount"),
        F.col("line_count").cast("bigint").alias("line_count"),
        "is_cancellation",
        "has_valid_positive_line",
    )


def customer_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer page of the top segment's representative: facts, segment, invoice and
    cancellation counts (C5, L3, E17)."""
    b = _b(spark, sf_dir)
    cid = b.demo_customer
    cust = b.segmented.where(F.col("customer_id") == cid)
    dim = b.profiles.select("segment_code", "segment_name")
    counts = (
        b.timeline.where(F.col("customer_id") == cid)
        .groupBy("customer_id")
        .agg(
            F.count(F.lit(1)).cast("bigint").alias("invoice_count"),
            F.count(F.when(F.col("is_cancellation"), 1)).cast("bigint").alias("cancellation_count"),
        )
    )
    return (
        cust.join(F.broadcast(dim), "segment_code")
        .join(counts, "customer_id", "left")
        .select(
            "customer_id",
            "segment_code",
            "segment_name",
            "country_display",
            "recency",
            "frequency",
            money_out(F.col("gross_monetary")).alias("gross_monetary"),
            money_out(F.col("net_monetary")).alias("net_monetary"),
            "centroid_distance",
            F.coalesce(F.col("invoice_count"), F.lit(0)).cast("bigint").alias("invoice_count"),
            F.coalesce(F.col("cancellation_count"), F.lit(0)).cast("bigint").alias("cancellation_count"),
            "is_representative",
            F.when(F.col("any_capped_flag"), F.lit("Yes")).otherwise(F.lit("No")).alias("capped_display"),
        )
    )


def customer_vs_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The representative's R, F, gross and net against its segment medians as bar widths."""
    b = _b(spark, sf_dir)
    cid = b.demo_customer
    cust = b.segmented.where(F.col("customer_id") == cid)
    long_c = cust.select(
        "segment_code",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(m).alias("metric"), (dec_to_double(F.col(m)) if "monetary" in m else F.col(m).cast("double")).alias("value"))
                    for m in PROFILE_METRICS
                ]
            )
        ),
    )
    long_p = b.profiles.select(
        "segment_code",
        F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(f"{m}_median").alias("median")) for m in PROFILE_METRICS])),
    )
    j = long_c.join(long_p, ["segment_code", "metric"])
    top, cw, mw = S.comparison(F.col("value"), F.col("median"))
    return j.select(
        "metric",
        F.col("value").alias("customer_value"),
        quantile_out(F.col("median")).alias("segment_median"),
        dbl(top).alias("top"),
        dbl(cw).alias("customer_width"),
        dbl(mw).alias("median_width"),
    )


def filtered_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Explorer filter: the two top segments, customers who bought in the home country or
    ASIA, uncapped only (C4, D3, H2)."""
    b = _b(spark, sf_dir)
    k = b.params.k
    f = S.filtered_customers(
        b.segmented, b.countries, [f"S{k - 1}", f"S{k}"], [b.params.home_country, "ASIA"], "uncapped"
    )
    return f.select("customer_id", "segment_code", "country_display", "any_capped_flag")


def country_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Countries with their customer counts, home country first then A–Z."""
    b = _b(spark, sf_dir)
    ci = S.country_index(b.countries, b.params.home_country)
    return ci.select("country", F.col("customers").cast("bigint").alias("customers"), F.col("option_order").cast("bigint").alias("option_order"))


def customer_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer option labels 'id · segment · countries' (B19, L5)."""
    seg = _b(spark, sf_dir).segmented
    from ..functions.text import option_label

    return seg.select(
        option_label(F.col("customer_id"), F.col("segment_code"), F.col("country_display")).alias("label"),
        F.col("customer_id").alias("value"),
    )


def explorer_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anonymous explorer points P0001.. in customer order, the page customer kept by id."""
    b = _b(spark, sf_dir)
    seg = b.segmented
    ranked = running_ranks(
        seg.select("customer_id", "segment_code", *XYZ, "recency", "frequency", "net_monetary", "any_capped_flag"),
        ["customer_id"],
        {"position": F.lit(1)},
        {"position": 1},
    )
    demo = F.col("customer_id") == F.lit(b.demo_customer)
    return ranked.select(
        F.when(demo, F.col("customer_id")).otherwise(F.format_string("P%04d", F.col("position"))).alias("point_id"),
        F.col("segment_code").alias("segment"),
        decimal_round(F.col(XYZ[0]), 8).alias("x"),
        decimal_round(F.col(XYZ[1]), 8).alias("y"),
        decimal_round(F.col(XYZ[2]), 8).alias("z"),
        F.col("recency").alias("r"),
        F.col("frequency").alias("f"),
        decimal_round(F.col("net_monetary"), 2).alias("m"),
        F.col("any_capped_flag").alias("capped"),
        demo.alias("demo"),
    )


def explorer_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Explorer partition of the points into segment × capped groups (empty groups never
    appear) with the centre of each visible segment (C9)."""
    b = _b(spark, sf_dir)
    m = b.model
    groups = b.segmented.groupBy("segment_code", "any_capped_flag").agg(F.count(F.lit(1)).cast("bigint").alias("customers"))
    centres = spark.createDataFrame(
        [(m.mapping[i], *c) for i, c in enumerate(m.centres)], "segment_code string, x double, y double, z double"
    )
    return groups.join(F.broadcast(centres), "segment_code").select(
        "segment_code",
        F.col("any_capped_flag").alias("capped"),
        "customers",
        F.col("x").alias("centre_recency"),
        F.col("y").alias("centre_frequency"),
        F.col("z").alias("centre_net_monetary"),
    )


def registry() -> dict:
    return {
        "feature_caps": feature_caps,
        "rfm_capped": rfm_capped,
        "rfm_scaled": rfm_scaled,
        "feature_finite_check": feature_finite_check,
        "kpp_weights": kpp_weights,
        "assign_nearest": assign_nearest,
        "lloyd_step": lloyd_step,
        "lloyd_trace": lloyd_trace,
        "lloyd_changes": lloyd_changes,
        "semantic_mapping": semantic_mapping,
        "majority_mapping": majority_mapping,
        "segment_profiles": segment_profiles,
        "cluster_centroids": cluster_centroids,
        "segment_counts": segment_counts,
        "representatives": representatives,
        "findings_high_value": findings_high_value,
        "overview_shares": overview_shares,
        "monotone_ladder": monotone_ladder,
        "long_tail": long_tail,
        "gross_net_gap": gross_net_gap,
        "line_funnel": line_funnel,
        "invoice_timeline": invoice_timeline,
        "customer_timeline": customer_timeline,
        "customer_page": customer_page,
        "customer_vs_segment": customer_vs_segment,
        "filtered_customers": filtered_customers,
        "country_index": country_index,
        "customer_options": customer_options,
        "explorer_points": explorer_points,
        "explorer_groups": explorer_groups,
    }
