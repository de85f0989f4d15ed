"""Secret scan over an incremental blob ledger (native functions only).

Every version of every document is addressed by the SHA-256 of its text, its *blob*. The ledger is a Parquet table with one
row for each scan of a blob: the (rule, rule version) pairs that were tried and the spans that they found. A scan looks at
distinct blobs only, takes from each the pairs that the ledger does not hold, and appends one row for each blob that had
any; a blob seen before, or a rule whose version has not moved, costs a look-up. Findings are joined back from the ledger
to every path (row) that holds the blob.

**Plan.** Copies are taken out in every task before the texts are dealt by blob, so a blob that a third of all rows hold is
one row a task. That one shuffle also serves the ledger look-up, the running sums that place the matches and the ledger
row. Matches leave the text as (gap, length) pairs; no text is shuffled again. Findings go back to the paths by (blob,
salt): paths are spread over ``SALTS`` and only blobs with findings are repeated for each salt, so a hot blob is split.

A scan appends its ledger rows in one write. One that is lost on the way leaves nothing behind, and the next scan repeats
it. Rows are read back without duplicates, so two scans of the same blob and rules do no harm.

Null texts count as empty. Empty texts and texts without a secret have zero counts. Repeated rows stay apart; null ids are
kept; very long texts are scanned whole (patterns are linear). Extra columns are ignored, and an empty table gives an empty
result and leaves the ledger as it was.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from .common import text_of


@dataclass(frozen=True)
class Rule:
    """A pattern (loops that cannot fail later are possessive: the same matches in linear time), its version, a cheap test
    that every text with a match passes, and what a match must pass besides."""

    name: str
    version: int
    pattern: str
    hint: str
    check: str = ""
    base: bool = False


#: Base rules of the contract (their order is the order of kinds), then those that the method adds.
RULES = (
    Rule("assign", 1, r"""(?i)(?:password|passwd|secret|token|api_?key)["']?+\x20*+[:=]\x20*+["']?+[A-Za-z0-9+/_.=-]++""", r"""(?i)(?:passw(?:or)?d|secret|token|key)["']?+\x20*+[:=]""",
         r"""^[^:=]++[:=]\x20*+["']?+[A-Za-z0-9+/_.=-]{12,}$""", True),
    Rule("access", 1, "AKIA[A-Z0-9]++", "AKIA", "^.{18,}$", True),
    Rule("hex", 1, "[0-9a-f]{16,}+", "[0-9a-f]{16}", "", True),
    Rule("private-key", 1, "-----BEGIN (?:[A-Z]+ ){0,3}PRIVATE KEY-----", "PRIVATE KEY"),
    Rule("hosted-token", 1, "(?:ghp|gho|ghs|ghu|glpat|xox[abprs])[_-][A-Za-z0-9_-]{16,}+", "gh[posu]_|glpat|xox"),
    Rule("web-token", 1, r"eyJ[A-Za-z0-9_-]{6,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+", "eyJ"),
    Rule("url-login", 1, r"://[A-Za-z0-9._~-]{1,64}:[^\x00-\x20/@:]{3,128}@", "://"),
)
SALTS = 16
LEDGER = "blob binary, tried array<struct<rule:string,version:int>>, spans array<struct<rule:string,version:int,start:long,end:long>>"


def blob_of(text: Column) -> Column:
    """The content address of a text."""
    return F.unhex(F.sha2(text.cast("binary"), 256))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger's rows (blob, tried, spans); none where nothing was ever written."""
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], LEDGER)


def _pairs(rules) -> Column:
    kind = "array<struct<rule:string,version:int>>"
    return F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("version")) for r in rules]).cast(kind)


def _matches(text: Column, rule: Rule, order: int, wanted: Column) -> Column:
    """(rule, number, gap before, length, passes) of each match of one rule, for blobs that still want it."""
    none = F.array().cast("array<struct<rule:int,n:int,gap:int,size:int,ok:boolean>>")
    gaps, found = F.split(text, rule.pattern, -1), F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    passes = (lambda v: v.rlike(rule.check)) if rule.check else (lambda v: F.lit(True))
    cut = F.transform(F.arrays_zip(F.slice(gaps, F.lit(1), F.size(found)).alias("gap"), found.alias("value")),
                      lambda x, i: F.struct(F.lit(order).alias("rule"), i.alias("n"), F.length(x["gap"]).alias("gap"),
                                            F.length(x["value"]).alias("size"), passes(x["value"]).alias("ok")))
    return F.when(wanted & text.rlike(rule.hint), cut).otherwise(none)


def pending(docs: DataFrame, ledger: DataFrame, rules=RULES, text_col: str = "text") -> DataFrame:
    """(blob, text, wanted): distinct blobs with the rule-version pairs that the ledger does not hold; none without any."""
    text = text_of(text_col)
    blobs = docs.select(blob_of(text).alias("blob"), text.alias("text")).dropDuplicates(["blob"])
    held = ledger.select("blob", F.explode("tried").alias("t")).groupBy("blob").agg(F.collect_set("t").alias("held"))
    wanted = F.array_except(_pairs(rules), F.coalesce("held", _pairs(())))
    return blobs.join(held, "blob", "left").select("blob", "text", wanted.alias("wanted")).where(F.size("wanted") > 0)


def scan_blobs(todo: DataFrame, rules=RULES) -> DataFrame:
    """Ledger rows of ``pending`` blobs."""
    text = F.col("text")
    wants = lambda r: F.exists("wanted", lambda w: w["rule"] == r.name)
    cut = todo.select("blob", "wanted", F.explode_outer(F.concat(*[_matches(text, r, n, wants(r)) for n, r in enumerate(rules)])).alias("m"))
    upto = Window.partitionBy("blob", "m.rule").orderBy("m.n").rowsBetween(Window.unboundedPreceding, 0)
    placed = cut.select("blob", "wanted", "m", F.sum(F.col("m.gap") + F.col("m.size")).over(upto).alias("end"))
    pair = F.get(_pairs(rules), F.col("m.rule"))
    span = F.struct(pair["rule"].alias("rule"), pair["version"].alias("version"), (F.col("end") - F.col("m.size")).alias("start"), F.col("end").alias("end"))
    return placed.groupBy("blob").agg(F.first("wanted").alias("tried"), F.collect_list(F.when(F.col("m.ok"), span)).alias("spans"))


def scan(docs: DataFrame, path: str, rules=RULES, text_col: str = "text") -> DataFrame:
    """Scan what the ledger at ``path`` has not seen of ``docs`` and append it; returns the ledger as it is then.

    ``path`` lies in storage that driver and executors share. Two scans at once may both take a new blob; its rows agree."""
    spark = docs.sparkSession
    scan_blobs(pending(docs, read_ledger(spark, path), rules, text_col), rules).write.mode("append").parquet(path)
    return read_ledger(spark, path)


def blob_findings(ledger: DataFrame, rules=RULES) -> DataFrame:
    """(blob, found): the spans of the present rule versions, each once, by start and then by the order of ``rules``."""
    orders = F.create_map(*[x for n, r in enumerate(rules) for x in (F.lit(r.name), F.struct(F.lit(n).alias("order"), F.lit(r.version).alias("version")))])
    spans = ledger.select("blob", F.explode("spans").alias("s")).select("blob", "s.*", F.try_element_at(orders, F.col("s.rule")).alias("now"))
    live = spans.where(F.col("version") == F.col("now.version"))
    return live.groupBy("blob").agg(F.array_sort(F.collect_set(F.struct("start", F.col("now.order").alias("order"), "end", "rule"))).alias("found"))


def secret_report(docs: DataFrame, ledger: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Findings of the ledger for every row of ``docs``: n_assign, n_access, n_hex, base_sha256, spans, blob (hex)."""
    names = [r.name for r in rules if r.base]
    shown = lambda found: F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["rule"], x["start"], x["end"])), ",")
    base = F.filter("found", lambda x: x["rule"].isin(names))
    count = lambda n: F.size(F.filter("found", lambda x: x["rule"] == n)).cast("long")
    reports = blob_findings(ledger, rules).select(
        "blob", *[count(n).alias(f"n_{n}") for n in names],
        F.sha2(shown(base).cast("binary"), 256).alias("base_sha256"), shown(F.col("found")).alias("spans"))
    spread = reports.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    paths = docs.select(F.col(id_col).alias("doc_id"), blob_of(text_of(text_col)).alias("blob"), F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int").alias("salt"))
    return paths.join(spread, ["blob", "salt"], "left").select(
        "doc_id", *[F.coalesce(f"n_{n}", F.lit(0)).cast("long").alias(f"n_{n}") for n in names],
        F.coalesce("base_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"),
        F.lower(F.hex("blob")).alias("blob"))
