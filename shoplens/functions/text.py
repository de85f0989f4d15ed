"""String expressions (JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import NA_TOKENS, PRODUCT_LIKE_PATTERN


#: What ``str.strip`` removes, as a character class: ASCII white space and separators, next line, no-break space and the
#: other Unicode spaces.
STRIPPED = r"[\x09-\x0D\x1C-\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"


def py_strip(c: Column) -> Column:
    """Trim like Python's ``str.strip()``: every kind of white space, not only ASCII blanks."""
    return F.regexp_replace(c, rf"^{STRIPPED}+|{STRIPPED}+$", "")


def na_to_null(c: Column) -> Column:
    """Turn the default missing-value tokens into null, as a CSV reader with NA defaults does."""
    return F.when(c.isin(*NA_TOKENS), F.lit(None).cast("string")).otherwise(c)


def is_product_like(stock_code: Column) -> Column:
    """Anchored full match of the product pattern; a null code is not product-like."""
    return F.coalesce(stock_code.rlike(PRODUCT_LIKE_PATTERN), F.lit(False))


def is_cancellation(invoice_no: Column) -> Column:
    """Invoice number starting with a capital C; a null invoice is not a cancellation."""
    return F.coalesce(invoice_no.startswith("C"), F.lit(False))


def country_display(country: Column) -> Column:
    """Aggregate: sorted distinct non-null countries joined by ' | ' (empty string when none)."""
    return F.array_join(F.array_sort(F.collect_set(country)), " | ")


def option_label(customer_id: Column, segment_code: Column, countries: Column) -> Column:
    """Customer option label: id, segment and countries joined by a middle dot."""
    return F.concat_ws(" · ", customer_id, segment_code, countries)
