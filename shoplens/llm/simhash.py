"""SimHash fingerprints and their search within a Hamming radius (native functions only).

Terms are overlapping word pairs of the lower-cased text, weighted by the length of their first word (1 to 8), so that
short function words count less. Each term's 64-bit hash votes on every bit with its weight. Votes are summed as
packed counters: bit ``j`` of four 16-bit lanes is added in one 64-bit sum, 16 sums in all, per (text, chunk of 2048
terms), so a lane never overflows and a text of any length is summed by partial aggregation; chunks are unpacked and
added afterwards. A fingerprint is a function of the text alone: equal texts have equal fingerprints.

Search: fingerprints are cut into ``blocks`` of bits; any two within the radius agree on ``blocks - radius`` blocks, so
a table per choice of that many blocks, keyed by their bits, finds all of them. A pair is emitted by the first
table that holds it. The tables hold distinct fingerprints with their counts, so copies cost nothing.

Null texts count as empty (all-zero fingerprint). Repeated rows and repeated ids stay apart (ordered by the text's
digest); null ids come last in descending order. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, pair_words, text_of, word_array

CHUNK = 2048  # terms whose votes share a packed counter: 2048 * 8 < 2**15
LANES = 0x0001000100010001
ROWS_A_BUCKET = 20_000


def fingerprints(texts: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """``keys`` (which name a row) and ``fp``, the 64-bit SimHash of the row's text."""
    words = texts.select(*keys, word_array(text_of(text_col)).alias("words"))
    hashed = pair_words("words", 2)
    # the weight rides in the low bits of the term, which is hashed once more for the votes
    packed = F.zip_with(hashed, F.col("words"), lambda h, w: h.bitwiseAND(~7).bitwiseOR(F.least(F.length(w), F.lit(8)).cast("long") - 1))
    terms = words.select(*keys, F.posexplode_outer(packed).alias("pos", "term"))
    vote, weight = F.xxhash64("term"), F.col("term").bitwiseAND(7) + 1
    votes = terms.select(*keys, F.shiftright("pos", 11).alias("chunk"), vote.alias("vote"),
                         F.when(F.col("term").isNull(), 0).otherwise(weight).alias("weight"))
    lanes = [F.sum(F.shiftrightunsigned("vote", j).bitwiseAND(LANES) * F.col("weight")).alias(f"s{j}") for j in range(16)]
    sums = votes.groupBy(*keys, "chunk").agg(F.sum("weight").alias("all"), *lanes)
    bits = [F.sum(F.shiftrightunsigned(F.col(f"s{j % 16}"), 16 * (j // 16)).bitwiseAND(0xFFFF)).alias(f"b{j}") for j in range(64)]
    added = sums.groupBy(*keys).agg(F.sum("all").alias("all"), *bits)
    fp = F.lit(0).cast("long")
    for j in range(64):
        fp = fp.bitwiseOR(F.when(F.col(f"b{j}") * 2 > F.col("all"), F.lit(1 << j if j < 63 else -(1 << 63)).cast("long")).otherwise(F.lit(0).cast("long")))
    return added.select(*keys, fp.alias("fp"))


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def likeness(a: Column, b: Column) -> Column:
    return (F.lit(64) - F.bit_count(a.bitwiseXOR(b))) / 64


def block_masks(blocks: int, radius: int) -> list[int]:
    """One mask for each choice of ``blocks - radius`` blocks of the 64 bits."""
    edges = [64 * n // blocks for n in range(blocks + 1)]
    parts = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(c) for c in combinations(parts, blocks - radius)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def near_pairs(asked: DataFrame, held: DataFrame, radius: int = 3, blocks: int = 6) -> DataFrame:
    """All pairs (``q`` of ``asked``, ``fp`` of ``held`` with its other columns) at most ``radius`` bits apart.

    ``asked`` has a column ``q`` and ``held`` a column ``fp``, both distinct. Six blocks and radius 3 give 20 tables
    with keys of 32 bits or so, which stay selective at billions of fingerprints."""
    masks = [_signed(m) for m in block_masks(blocks, radius)]

    def keyed(df: DataFrame, col: str) -> DataFrame:
        cells = F.array(*[F.struct(F.lit(n).alias("t"), F.col(col).bitwiseAND(m).alias("key")) for n, m in enumerate(masks)])
        return df.withColumn("cell", F.explode(cells)).select(*df.columns, "cell.t", "cell.key")

    differ = F.col("q").bitwiseXOR(F.col("fp"))
    first = F.lit(len(masks))
    for n, m in reversed(list(enumerate(masks))):
        first = F.when(differ.bitwiseAND(m) == 0, n).otherwise(first)
    a, b = keyed(asked, "q"), keyed(held, "fp")
    on = (a["t"] == b["t"]) & (a["key"] == b["key"]) & (F.bit_count(differ) <= radius) & (first == a["t"])
    return a.hint("merge").join(b, on).drop("t", "key")  # keys are exploded: sizes known before that say nothing


def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (bucket, n, doc_id, text, after, own) in descending order of the id; ``after`` is the next row's text.

    Buckets are ranges of the id from approximate quantiles, dealt by one shuffle. The row that a bucket's last row
    needs is the first one of the next range: rows that hold a range's largest id are put into the bucket above as
    well (``own`` false there), and the largest id of all follows the last row."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("id"), F.col(id_col).alias("doc_id"),
                       text_of(text_col).alias("text"))
    count = rows.count()
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-count // ROWS_A_BUCKET)) if count else 1
    cuts = rows.agg(F.percentile_approx("id", [n / buckets for n in range(1, buckets)] or [0.5], 10 * max(buckets, 1000))).first()[0] or []
    cuts = sorted(set(cuts))
    if cuts:
        bounds = F.array(*[F.lit(c).cast("long") for c in cuts])
        bucket = F.size(F.filter(bounds, lambda b: b < F.col("id")))  # 0 holds the smallest ids
    else:
        bucket = F.lit(0)
    tops = rows.select("id", bucket.alias("bucket")).groupBy("bucket").agg(F.max("id").alias("top")).collect()  # one row a bucket
    tops = sorted((r["bucket"], r["top"]) for r in tops)
    if not tops:
        tops = [(0, 0)]
    above = {t: tops[(n + 1) % len(tops)][0] for n, (_, t) in enumerate(tops)}  # wraps: the largest id follows the last row
    guest = F.create_map(*[F.lit(x) for t, b in above.items() for x in (t, b)])
    seat = F.struct(bucket.alias("bucket"), F.lit(True).alias("own"))
    second = F.struct(F.try_element_at(guest, F.col("id")).alias("bucket"), F.lit(False).alias("own"))
    seats = F.when(F.col("id").isin([t for _, t in tops]), F.array(seat, second)).otherwise(F.array(seat))
    # the text's digest breaks ties between repeated ids; a guest stands after all rows of the bucket it visits
    placed = rows.withColumn("seat", F.explode(seats)).select("id", "doc_id", "text", "seat.*", F.md5(F.col("text").cast("binary")).alias("digest"))
    order = Window.partitionBy("bucket").orderBy(F.col("own").desc(), F.col("id").desc(), "digest")
    return placed.select("bucket", "own", "doc_id", "text", F.row_number().over(order).alias("n"), F.lead("text").over(order).alias("after"))


def fingerprint_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 3, blocks: int = 6,
                       ask_every: int = 20) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next and, for the stated
    query rows (ids divisible by ``ask_every``), n_near: the other documents whose fingerprint is within the radius."""
    placed = with_next(docs, id_col, text_col)
    chars = F.length("text")
    half = F.floor(chars / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), chars - half), F.substring(F.coalesce(F.col("after"), F.lit("")), F.lit(1), half))
    rows = placed.select("bucket", "n", "own", "doc_id", chars.alias("n_chars"), "text", edited.alias("edited"))
    facts = rows.select("bucket", "n", "own", "doc_id", F.col("n_chars").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"))
    # the same columns as ``facts`` takes, so that the one shuffle of the texts serves both
    both = rows.select("bucket", "n", "own", "doc_id", F.explode(F.array(F.struct(F.lit(0).alias("kind"), "text"), F.struct(F.lit(1).alias("kind"), F.col("edited").alias("text")))).alias("v")
                       ).select("bucket", "n", "own", "doc_id", "v.kind", "v.text")
    prints = fingerprints(both, ["bucket", "n", "own", "doc_id", "kind"]).groupBy("bucket", "n").agg(
        F.max(F.when(F.col("kind") == 0, F.col("fp"))).alias("fp"), F.max(F.when(F.col("kind") == 1, F.col("fp"))).alias("edited_fp"))
    joined = facts.join(prints, ["bucket", "n"])
    follows = Window.partitionBy("bucket").orderBy("n")
    table = materialize(joined.withColumn("next_fp", F.lead("fp").over(follows)).where("own").drop("own", "bucket", "n"), "fingerprints")
    held = table.groupBy("fp").agg(F.count("*").alias("rows"))
    asks = F.col("doc_id") % ask_every == 0
    asked = table.where(asks).select(F.col("fp").alias("q")).distinct()
    near = near_pairs(asked, held, radius, blocks).groupBy("q").agg((F.sum("rows") - 1).alias("near"))
    return table.join(near, F.col("fp") == F.col("q"), "left").select(
        "doc_id", "n_chars", "edited_sha256", as_hex(F.col("fp")).alias("fingerprint"), as_hex(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
        F.when(asks, F.col("near")).alias("n_near"))
