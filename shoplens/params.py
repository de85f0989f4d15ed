"""Run parameters and fixed values.

Everything a job can vary lives in :class:`Params` (a frozen dataclass that is
passed down explicitly); nothing reads module globals at run time.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# --- fixed values (must equal the published behaviour for identical results) ---
# Source columns, in the exact order the CSV header must have.
SOURCE_COLUMNS = (
    "InvoiceNo",
    "StockCode",
    "Description",
    "Quantity",
    "InvoiceDate",
    "UnitPrice",
    "CustomerID",
    "Country",
)
# Stock codes that look like products: five digits and up to two capital letters.
PRODUCT_LIKE_PATTERN = r"^[0-9]{5}[A-Z]{0,2}$"
# Country display separator.
COUNTRY_SEPARATOR = " | "
# Text tokens that pandas' CSV reader turns into missing values by default.
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)
# Segment dimension S1..S4: name, description, strategy hypothesis, future KPIs.
SEGMENTS = (
    (
        "S1",
        "Long-inactive",
        "Long time since last purchase, with low frequency and observed Net value.",
        "Test a low-cost reactivation message against a no-contact control.",
        "Reactivation rate; Net value per contacted customer",
    ),
    (
        "S2",
        "Regular",
        "The customer majority, with mid-range recency, frequency and observed Net value.",
        "Test reorder reminders or product bundles against the current experience.",
        "Repeat-purchase rate; average invoice value",
    ),
    (
        "S3",
        "Active high-value",
        "Recent, repeated purchasing with high observed Net value.",
        "Test loyalty and retention benefits while measuring incremental behavior.",
        "Retention; purchase frequency; incremental Net value",
    ),
    (
        "S4",
        "Top-frequency high-value",
        "The most recent and frequent behavior, with very high observed Net value.",
        "Test VIP or high-contact service with an explicit control group.",
        "Retention; incremental Net value; service cost",
    ),
)
# Model defaults: k, restarts, seed, iteration limit, cap quantile.
MODEL_K = 4
MODEL_N_INIT = 20
MODEL_SEED = 431
MAX_ITER = 300
CAP_QUANTILE = 0.995
# Evaluation grid: k values, single-init seeds, cap thresholds.
K_VALUES = (2, 3, 4, 5, 6, 7, 8)
SEEDS = tuple(range(50))
CAP_SPECS = (("none", None), ("cap990", 0.99), ("cap995", 0.995), ("cap999", 0.999))
# Stop-condition thresholds of the directed sensitivity check.
MIN_COMMON_ARI = 0.8
MIN_K4_ARI = 0.8
MAX_S3S4_SHARE_SHIFT = 0.10
MIN_S4_CUSTOMER_SHARE = 0.01
# Line variants of the directed sensitivity check.
VARIANTS = ("duplicates_kept", "product_like_only", "home_country_only")
SCHEMA_VERSION = 1
FEATURES = ("recency", "frequency_capped", "net_monetary_capped")
# --- end of fixed values ---

# Rounding used wherever two engines must agree bit for bit on doubles.
FEATURE_DIGITS = 10
DISTANCE_DIGITS = 10
OUTPUT_DIGITS = 6
MONEY_SQL_TYPE = "decimal(18,4)"


@dataclass(frozen=True)
class Params:
    """Parameters of one build. Dates are ISO strings."""

    reference_date: str = "2001-08-02"
    home_country: str = "EUROPE"
    cap_quantile: float | None = CAP_QUANTILE
    k: int = MODEL_K
    seed: int = MODEL_SEED
    n_init: int = MODEL_N_INIT
    max_iter: int = MAX_ITER
    tol: float = 0.0  # 0: a fit goes on until none of its centres moves
    k_values: tuple[int, ...] = K_VALUES
    seeds: tuple[int, ...] = SEEDS
    cap_specs: tuple[tuple[str, float | None], ...] = CAP_SPECS
    variants: tuple[str, ...] = VARIANTS
    segments: tuple[tuple[str, str, str, str, str], ...] = field(default=SEGMENTS)

    def with_(self, **changes) -> "Params":
        return replace(self, **changes)


DEFAULT = Params()
