"""Audits: net reconciliation, content fingerprints, expected and archived facts. Every check runs distributed and only
counts reach the driver."""

from __future__ import annotations

import hashlib
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .lines import running_ranks

FINGERPRINT_BUCKET = 1_000_000


def net_reconciliation(customers: DataFrame, lines: DataFrame) -> DataFrame:
    """Customer net against Σ line amounts per customer: compared rows and largest gap."""
    line_net = lines.groupBy("customer_id").agg(F.sum("line_amount").alias("line_net"))
    j = customers.select("customer_id", "net_monetary").join(line_net, "customer_id")
    return j.agg(
        F.count(F.lit(1)).cast("bigint").alias("customers_compared"),
        F.max(F.abs(F.col("net_monetary") - F.col("line_net"))).cast("double").alias("max_abs_difference"),
    ).withColumn("within_tolerance", F.col("max_abs_difference") <= F.lit(1e-6))


def bucketed_fingerprint(df: DataFrame, key: str, line, bucket: int = FINGERPRINT_BUCKET) -> DataFrame:
    """SHA-256 content fingerprint of ``line`` over rows in ``key`` order, in two levels:
    rows are numbered in key order (distributed), cut into buckets of ``bucket`` rows, each
    bucket hashed as its lines joined by newlines, and the bucket hashes hashed in bucket
    order. No group or task ever holds more than one bucket."""
    ranked = running_ranks(df.select(F.col(key).alias("_k"), line.alias("_line")), ["_k"], {"_r": F.lit(1)}, {"_r": 0})
    per = ranked.groupBy((F.col("_r") / bucket).cast("bigint").alias("_b")).agg(
        F.sha2(F.expr("listagg(_line, '\\n') WITHIN GROUP (ORDER BY _k)"), 256).alias("_h"),
        F.count(F.lit(1)).alias("_n"),
    )
    return per.agg(
        F.sha2(F.expr("listagg(_h, '') WITHIN GROUP (ORDER BY _b)"), 256).alias("fingerprint"),
        F.count(F.lit(1)).cast("bigint").alias("buckets"),
        F.sum("_n").cast("bigint").alias("rows"),
    )


def expectation_report(spark: SparkSession, actual: dict, expected: dict, tolerance: float = 1e-6) -> DataFrame:
    """(check_name, expected, actual, passed) of named facts, a few rows: numbers agree within ``tolerance``, texts exactly; a
    fact that is missing fails."""

    def same(a, b) -> bool:
        if isinstance(a, int | float) and isinstance(b, int | float):
            return abs(float(a) - float(b)) <= tolerance
        return a is not None and str(a) == str(b)

    rows = [(name, str(want), None if actual.get(name) is None else str(actual[name]), same(actual.get(name), want))
            for name, want in sorted(expected.items())]
    return spark.createDataFrame(rows, "check_name string, expected string, actual string, passed boolean")


def require_passed(report: DataFrame) -> DataFrame:
    """The report itself when all checks passed, else an error that names every failed one."""
    failed = report.where("not passed").orderBy("check_name").collect()
    if failed:
        raise ValueError("failed checks: " + "; ".join(f"{r['check_name']}: expected {r['expected']}, got {r['actual']}" for r in failed))
    return report


def archive_comparison(computed: DataFrame, archive: DataFrame, keys: list[str], metrics: list[str], tolerance: float = 1e-9) -> DataFrame:
    """Computed metrics against archived ones of the same keys: (keys, metric, computed, archived, passed); a row that only
    one side has fails."""
    long = lambda df, name: df.select(*keys, *[F.col(m).cast("double") for m in metrics]).unpivot(keys, metrics, "metric", name)
    both = long(computed, "computed").join(long(archive, "archived"), [*keys, "metric"], "full")
    close = F.coalesce(F.abs(F.col("computed") - F.col("archived")) <= tolerance, F.lit(False))
    return both.withColumn("passed", close)


def content_digest(df: DataFrame) -> str:
    """A digest of a table's rows that no order or partitioning can change: the row count and exact sums of two 64-bit
    hashes of each row. Two inputs that differ in any line get different digests (up to hash collisions)."""
    row = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("a"),
        F.sum(F.xxhash64(F.lit(1), *df.columns).cast("decimal(38,0)")).alias("b"),
    ).first()
    return hashlib.sha256(f"{row['n']}|{row['a']}|{row['b']}".encode()).hexdigest()


def build_id(assignment_id: str, input_digest: str) -> str:
    """Identifier of a build: the assignment's id (schema, reference date, segments) together with its input."""
    return hashlib.sha256(f"{assignment_id}|{input_digest}".encode()).hexdigest()[:20]
