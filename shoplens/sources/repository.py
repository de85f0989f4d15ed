"""Reading a written build: schema gate, filters, look-ups and ordered scans over the stored tables.

Every function reads the Parquet tables that ``sinks.write_build`` wrote, so nothing is fitted again. Customer filters
reach the scan; orders are the stored keys' orders.
"""

from __future__ import annotations

import json
import os
from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import option_label
from ..operators.serving import country_index, filtered_customers
from .sinks import assert_schema_version, read_model_params

#: Two-dimensional slices of the scaled features: name -> the axes that are drawn.
SLICES = {
    "rf": ("scaled_recency", "scaled_frequency"),
    "rm": ("scaled_recency", "scaled_net_monetary"),
    "fm": ("scaled_frequency", "scaled_net_monetary"),
}


class StoredBuild:
    """A build in a folder. Opening it checks the schema version."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        assert_schema_version(self.table("model_metadata"))

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(os.path.join(self.path, name))

    @cached_property
    def manifest(self) -> dict:
        return json.loads(self.spark.read.text(os.path.join(self.path, "_manifest")).first()[0])

    @cached_property
    def metadata(self) -> dict[str, object]:
        """Metadata values by key, typed by their stored value type (a few rows)."""
        read = {"integer": int, "real": lambda v: None if v == "None" else float(v), "json": json.loads}
        return {r["metadata_key"]: read.get(r["value_type"], str)(r["metadata_value"]) for r in self.table("model_metadata").collect()}

    @property
    def model(self) -> dict:
        return read_model_params(self.spark, os.path.join(self.path, "model_params"))

    @property
    def customers(self) -> DataFrame:
        seg = self.table("customer_segments")
        flags = [c for c, t in seg.dtypes if c.endswith("_flag") or c.startswith("is_")]
        return seg.withColumns({c: F.col(c).cast("boolean") for c in flags})

    # --- ordered scans
    def lines(self) -> DataFrame:
        return self.table("transaction_lines").orderBy("line_id")

    def profiles(self) -> DataFrame:
        return self.table("segment_profiles").orderBy("segment_order")

    def filtered_customers(self, segments: Sequence[str] = (), countries: Sequence[str] = (), cap_status: str = "all") -> DataFrame:
        found = filtered_customers(self.customers, self.table("customer_countries"), segments, countries, cap_status)
        return found.orderBy("segment_code", "customer_id")

    def timeline(self, customer_id: str) -> DataFrame:
        """One customer's invoices by time, then number. The filter reaches the scan."""
        return self.table("invoice_timeline").where(F.col("customer_id") == customer_id).orderBy("invoice_date", "invoice_no")

    # --- look-ups
    def customer(self, customer_id: str) -> dict:
        """One customer's row; an unknown id is an error."""
        row = self.customers.where(F.col("customer_id") == customer_id).first()
        if row is None:
            raise KeyError(f"unknown customer: {customer_id}")
        return row.asDict()

    def customer_or_first(self, customer_id: str | None) -> dict:
        """The page's fallback: the customer asked for, or the top segment's representative."""
        try:
            if customer_id:
                return self.customer(customer_id)
        except KeyError:
            pass
        found = self.representative_ids()
        return self.customer(found[max(found, key=lambda c: int(c[1:]))])

    def profile(self, segment_code: str) -> dict:
        row = self.table("segment_profiles").where(F.col("segment_code") == segment_code).first()
        if row is None:
            raise KeyError(f"unknown segment: {segment_code}")
        return row.asDict()

    def representative_ids(self) -> dict[str, str]:
        return {r["segment_code"]: r["customer_id"] for r in self.customers.where("is_representative").select("segment_code", "customer_id").collect()}

    # --- options and points
    def country_options(self, home_country: str) -> DataFrame:
        return country_index(self.table("customer_countries"), home_country).orderBy("option_order")

    def customer_options(self) -> DataFrame:
        label = option_label(F.col("customer_id"), F.col("segment_code"), F.col("country_display"))
        return self.customers.select("customer_id", label.alias("label")).orderBy("customer_id")

    def points(self, axes: str = "rf", segments: Sequence[str] = (), countries: Sequence[str] = (), cap_status: str = "all") -> DataFrame:
        """Points of the filtered customers on one slice of the scaled features, capped ones told apart. An unknown slice is
        the first one."""
        x, y = SLICES.get(axes, SLICES["rf"])
        rows = filtered_customers(self.customers, self.table("customer_countries"), segments, countries, cap_status)
        return rows.select("customer_id", "segment_code", F.col("any_capped_flag").alias("capped"), F.col(x).alias("x"), F.col(y).alias("y"))

    # --- verification
    def fingerprint_matches(self) -> bool:
        """The stored assignment fingerprint against the one of the stored customers."""
        from ..operators.audit import bucketed_fingerprint

        seg = self.table("customer_segments")
        now = bucketed_fingerprint(seg, "customer_id", F.concat_ws(",", "customer_id", "segment_code")).first()
        return now["fingerprint"] == self.metadata["assignment_sha256"]

    def changed_tables(self) -> list[str]:
        """Stored tables whose rows are not those that the manifest's digests were taken of, in any order of rows or files."""
        from ..operators.audit import content_digest

        return [n for n, digest in sorted(self.manifest["digests"].items()) if content_digest(self.table(n)) != digest]

    def verify(self, expected: dict[str, float | str] | None = None) -> DataFrame:
        """Counts and contents of the manifest's tables, the fingerprint and any expected facts of the caller as (check_name, expected, actual,
        passed); raises after all checks when one fails."""
        from ..operators.audit import expectation_report, require_passed

        actual: dict[str, float | str] = {f"rows:{n}": float(self.table(n).count()) for n in sorted(self.manifest["counts"])}
        wanted: dict[str, float | str] = {f"rows:{n}": float(c) for n, c in self.manifest["counts"].items()}
        changed = set(self.changed_tables())
        actual |= {f"content:{n}": "changed" if n in changed else "same" for n in self.manifest["digests"]}
        wanted |= {f"content:{n}": "same" for n in self.manifest["digests"]}
        actual["assignment_fingerprint"] = "same" if self.fingerprint_matches() else "different"
        wanted["assignment_fingerprint"] = "same"
        for r in self.table("core_checks").collect():
            actual[r["check_name"]] = r["actual_text"] if r["actual_text"] is not None else r["actual_value"]
        report = expectation_report(self.spark, actual, wanted | (expected or {}))
        return require_passed(report)
