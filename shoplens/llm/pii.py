"""Personal data: patterns propose, checksums confirm, context words adjust the score (native functions only).

For each kind the text is cut by its pattern into matches and the gaps between them, so every match's place in code
points is a running sum of lengths: gaps and matches are exploded (without the text) and summed in a window over one
row's matches. Validators run on the matches only: octets of an address, Luhn for cards, digit counts of phones,
mod-97 for bank account numbers; a key-like token counts only when a context word stands just before it.

The patterns of the four base kinds are the contract's. They are written so that Java's matcher stays linear on long
runs (possessive loops; a start inside a run only where the previous match ended, ``\\G``), with the same matches.

Null texts count as empty. Empty texts and texts without spans give a row with zero counts. Repeated rows stay apart;
extra columns are kept by ``redact`` and ignored by the reports; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import row_id, text_of


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    hint: str  # a cheap test that every text with a match passes
    context: str
    base: bool = True


_LOCAL = "A-Za-z0-9._%+-"
KINDS = (
    Kind("email", rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", "mail|contact|write"),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}", r"[0-9]\.[0-9]", r"\bip\b|address|host|server"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", "[0-9]{2}|[0-9][\x20-][0-9]", "card|visa|master|credit|payment"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", "phone|tel|call|mobile|fax"),
    Kind("iban", r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?", "[A-Z]{2}[0-9]{2}", "iban|bank|account", False),
    Kind("token", r"(?:\G|(?<![0-9A-Fa-f]))[0-9A-Fa-f]{32,}+", "[0-9A-Fa-f]{32}", "token|secret|passw|key", False),
)
WINDOW = 40  # code points before a match that count as its context


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Checksum of a string of digits: every second one from the right is doubled, 9 taken off above 9."""
    back = F.reverse(digits)

    def worth(i: Column) -> Column:
        d = F.substring(back, i + 1, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.transform(F.sequence(F.lit(0), F.length(digits) - 1), worth), F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(value: Column) -> Column:
    """ISO 7064 check of an account number: first four characters last, letters as 10 to 35, remainder 1."""
    plain = F.regexp_replace(value, " ", "")
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))

    def step(rest: Column, i: Column) -> Column:
        code = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(code < 58, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


def _valid(kind: str, value: Column, before: Column, after: Column) -> Column:
    digits = _digits(value)
    edge = ~before.rlike("[A-Za-z0-9]$") & ~after.rlike("^[A-Za-z0-9]")
    if kind == "ip":
        octet = r"0*(?:[0-9]|[1-9][0-9]|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
        return value.rlike(rf"^{octet}(?:\.{octet}){{3}}$")
    if kind == "card":
        return F.when(F.length(digits).between(16, 19), luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(8, 15)
    if kind == "iban":
        return F.when(edge & F.length(F.regexp_replace(value, " ", "")).between(15, 34), mod97(value)).otherwise(F.lit(False))
    if kind == "token":
        return edge & before.rlike(r"(?i)(?:token|secret|passw(?:or)?d|key)[^A-Za-z0-9]{1,6}$")
    return F.lit(True)


def _pieces(text: Column, kind: Kind, order: int) -> Column:
    """Array of (kind, number, gap before, match, text just before, character after)."""
    none = F.array().cast("array<struct<kind:int,n:int,gap:int,value:string,before:string,after:string>>")
    gaps, found = F.split(text, kind.pattern, -1), F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    cut = F.transform(F.arrays_zip(F.slice(gaps, F.lit(1), F.size(found)).alias("gap"), found.alias("value"),
                                   F.slice(gaps, F.lit(2), F.size(found)).alias("next")),
                      lambda x, i: F.struct(F.lit(order).alias("kind"), i.alias("n"), F.length(x["gap"]).alias("gap"), x["value"].alias("value"),
                                            F.right(x["gap"], F.lit(WINDOW)).alias("before"), F.left(x["next"], F.lit(1)).alias("after")))
    return F.when(text.rlike(kind.hint), cut).otherwise(none)


def pii_spans(docs: DataFrame, kinds=KINDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per confirmed span: row, doc_id, kind, start, end (code points, end exclusive), value, score;
    rows without a span are kept once with a null kind."""
    text = text_of(text_col)
    cut = docs.select(row_id().alias("row"), F.col(id_col).alias("doc_id"),
                      F.concat(*[_pieces(text, k, n) for n, k in enumerate(kinds)]).alias("m"))
    # the narrow matches are dealt once by row, for the window as for the report
    rows = cut.select("row", "doc_id", F.explode_outer("m").alias("m")).select("row", "doc_id", "m.*").repartition("row")
    upto = Window.partitionBy("row", "kind").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    ends = rows.withColumn("end", F.sum(F.col("gap") + F.length("value")).over(upto))
    value, before, after = F.col("value"), F.col("before"), F.col("after")
    valid = F.lit(False)
    context = F.lit(False)
    for n, k in enumerate(kinds):
        valid = F.when(F.col("kind") == n, _valid(k.name, value, before, after)).otherwise(valid)
        context = F.when(F.col("kind") == n, before.rlike(f"(?i)(?:{k.context})")).otherwise(context)
    names = F.array(*[F.lit(k.name) for k in kinds])
    checked = F.col("kind").isin([n for n, k in enumerate(kinds) if k.name in ("card", "iban")])
    score = (F.lit(50) + F.when(checked, 30).otherwise(10) + F.when(context, 20).otherwise(0)) / 100
    ok = F.coalesce(valid, F.lit(False))
    return ends.withColumn("ok", ok).select(
        "row", "doc_id", F.when(F.col("ok"), F.col("kind")).alias("order"), F.when(F.col("ok"), F.get(names, F.col("kind"))).alias("kind"),
        F.when(F.col("ok"), F.col("end") - F.length("value")).alias("start"), F.when(F.col("ok"), F.col("end")).alias("end"),
        F.when(F.col("ok"), value).alias("value"), F.when(F.col("ok"), score).alias("score"))


def pii_report(docs: DataFrame, kinds=KINDS, **options) -> DataFrame:
    """One row per document: base counts, digest of the base spans, and all spans as text."""
    spans = pii_spans(docs, kinds, **options)
    base = [n for n, k in enumerate(kinds) if k.base]

    def joined(keep: Column) -> Column:
        listed = F.array_sort(F.collect_list(F.when(keep, F.struct("order", "start", "end", "kind"))))
        return F.array_join(F.transform(listed, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    return spans.groupBy("row", "doc_id").agg(
        *[F.count(F.when(F.col("order") == n, 1)).alias(f"n_{kinds[n].name}") for n in base],
        F.sha2(joined(F.col("order").isin(base)), 256).alias("base_sha256"),
        joined(F.col("order").isNotNull()).alias("spans"),
        F.coalesce(F.max("score"), F.lit(0.0)).alias("best_score"),
    ).drop("row")


def redact(docs: DataFrame, kinds=KINDS, text_col: str = "text") -> DataFrame:
    """The same rows with each confirmed span replaced by its kind in brackets.

    Runs inside the row without any shuffle: kind after kind, the gaps and (confirmed) matches are joined again. Kinds
    that take longer spans go first, so that a phone pattern does not cut a card in two. Null texts stay null.
    """
    text = F.col(text_col)
    rank = {"email": 0, "iban": 1, "card": 2, "token": 3, "phone": 4, "ip": 5}
    out = docs
    for k in sorted(kinds, key=lambda k: rank.get(k.name, 9)):
        gaps, found = F.split(text, k.pattern, -1), F.regexp_extract_all(text, F.lit(k.pattern), F.lit(0))
        cell = F.arrays_zip(gaps.alias("gap"), found.alias("value"), F.slice(gaps, F.lit(2), F.size(gaps)).alias("next"))
        clean = F.array_join(F.transform(cell, _replacement(k.name)), "")
        out = out.withColumn(text_col, F.when(text.rlike(k.hint), clean).otherwise(text))
    return out


def _replacement(kind: str):
    """A gap and what follows it: nothing after the last gap, the kind for a confirmed match, else the match itself."""

    def piece(x: Column) -> Column:
        confirmed = _valid(kind, x["value"], F.right(x["gap"], F.lit(WINDOW)), F.left(x["next"], F.lit(1)))
        return F.concat(x["gap"], F.when(x["value"].isNull(), F.lit("")).when(confirmed, F.lit(f"[{kind.upper()}]")).otherwise(x["value"]))

    return piece
