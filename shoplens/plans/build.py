"""The build graph: one memoised set of lazy DataFrames per (session, input folder, params).

Each stage is declared once; queries pick the stages they need. The line table, the RFM table and the customer table
are each written once as Parquet in the shared checkpoint folder, when a query first needs them. The source is the
driver's star tables or any DataFrame in the 8-column layout, such as a CSV scan.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import lines as L
from ..operators import rfm as R
from ..params import DEFAULT, Params
from ..session import materialize
from ..sources.adapter import LINE_COLUMNS, source_lines

_BUILDS: dict[tuple, "Build"] = {}


class Build:
    def __init__(self, spark: SparkSession, sf_dir: str, params: Params = DEFAULT, source: DataFrame | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.params = params
        self.source = source

    @classmethod
    def from_csv(cls, spark: SparkSession, path: str, params: Params = DEFAULT, multi_line: bool = False) -> "Build":
        """A build over a CSV file or folder. Copies are removed on the text of the eight columns, as written (two
        spellings of one date are two lines), and the first one in file order is kept, with its row number."""
        from ..sources.csv_source import in_source_order

        return cls(spark, path, params, in_source_order(spark, path, multi_line))

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str, params: Params = DEFAULT) -> "Build":
        key = (id(spark), spark.sparkContext.applicationId, sf_dir, params)
        if key not in _BUILDS:
            _BUILDS[key] = cls(spark, sf_dir, params)
        return _BUILDS[key]

    # --- lines ---
    @cached_property
    def raw(self) -> DataFrame:
        return source_lines(self.spark, self.sf_dir, keyed=True) if self.source is None else self.source

    @cached_property
    def dedup(self) -> DataFrame:
        """The source after exact-copy removal, with the copy count of every line: written
        once (Parquet, shared checkpoint folder), so the star-schema joins run once per build
        and every line-level query scans only the columns it needs."""
        return self.stored.select(*LINE_COLUMNS, "copies", *[c for c in ("source_row_number",) if c in self.stored.columns])

    @cached_property
    def stored(self) -> DataFrame:
        """Raw and normalised columns of every deduplicated line, written once."""
        distinct = L.deduplicate(self.raw)
        if dict(distinct.dtypes)["invoice_date"] == "string":  # text lines: typed only now, after the copies are gone
            from ..sources.csv_source import typed

            distinct = typed(distinct)
        return materialize(L.with_normalised(distinct), "lines")

    @cached_property
    def lines(self) -> DataFrame:
        """Known, normalised, flagged lines of the deduplicated source."""
        return L.known_lines(L.normalised_view(self.stored).drop("copies"), normalised=True)

    @cached_property
    def raw_known_lines(self) -> DataFrame:
        """Known lines with copies kept (the duplicates-kept variant), as weighted rows: each
        deduplicated line once, its amount multiplied by its copy count. Everything the RFM
        reads is either copy-invariant (dates, distinct invoices, countries, flags) or a sum
        of amounts, so this equals the raw source without ever materialising a group of
        copies (which may hold a third of all rows) in one task."""
        lines = L.known_lines(L.normalised_view(self.stored), normalised=True)
        return lines.withColumn("line_amount", (F.col("line_amount") * F.col("copies")).cast("decimal(38,4)")).drop("copies")

    @cached_property
    def numbered(self) -> DataFrame:
        return L.number_deduplicated(self.dedup)

    # --- customers ---
    @cached_property
    def rfm(self) -> DataFrame:
        """Written once (Parquet, shared checkpoint folder): every customer-level query
        starts here, not at the lines, and reads only the columns it needs."""
        return materialize(R.build_rfm(self.lines, self.params), "rfm")

    @cached_property
    def countries(self) -> DataFrame:
        return R.customer_countries(self.lines, self.rfm)

    # --- model ---
    @cached_property
    def model(self):
        from ..operators.model import fit_model

        return fit_model(self.rfm, self.params)

    @cached_property
    def segmented(self) -> DataFrame:
        return self.model.segmented()

    @cached_property
    def demo_customer(self) -> str:
        """The representative of the top segment (the customer the pages open on)."""
        reps = self.model.representatives
        return reps[max(reps, key=lambda c: int(c[1:]))]

    @cached_property
    def trace(self) -> list[dict]:
        """Lloyd trace of the first restart of the final model (model seed, init 0)."""
        from ..operators.kmeans import trace

        return trace(self.model.points, self.model.states[0], self.params.max_iter)

    @cached_property
    def profiles(self) -> DataFrame:
        from ..operators.segments import dimension, profiles

        return profiles(self.segmented, dimension(self.spark, self.params.segments))

    @cached_property
    def timeline(self) -> DataFrame:
        from ..operators.serving import invoice_timeline

        return invoice_timeline(self.lines)

    @cached_property
    def sweep(self):
        from ..operators.sweeps import Sweep

        return Sweep(self)
