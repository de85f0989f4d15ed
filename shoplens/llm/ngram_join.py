"""N-gram Jaccard self-join by a grouped prefix join, as classes and their components.

1. Every text becomes its set of k-word shingle hashes. Texts with equal sets form one class (map-side combined).
2. In hash order, two sets that reach the threshold share at least ``l`` of their first ``p - 1 + l`` tokens (``p`` is the
   usual prefix length). Only these *extended prefixes* are exploded and counted; a class whose extended prefix
   shares fewer tokens with others than any partner would need is done: nothing can be linked with it.
3. The classes left get their whole sets counted. A token that no other class holds can be in no overlap, so a class with
   more such tokens than any partner allows is done as well. For the rest, these tokens are dropped and the others
   ordered by rarity; the first ones are the joinable prefix. Classes with the same size and the same joinable prefix form
   one *group*.
4. Groups are joined on prefix tokens under the size and overlap filters. First each bucket's groups are checked against the
   bucket's group with the fewest tokens of its own, and each group's members against their group's least member: as
   many pairs as members. Their links are contracted to components; then every pair of groups that share a bucket is
   expanded, but only to members whose components still differ. Pairs inside a component cannot change the result, so a
   large group of near copies costs no square. Each set has a bitmap in which every token turns one bit: sets whose bitmaps
   differ in more bits than the threshold lets tokens differ are no pair, and never become a row. No other pair is left out.
5. Pairs are verified on whole sets.

Null and empty texts, and texts without words, have the empty set: size 0, linked with nothing, a component of their own.
Repeated rows and repeated ids are each returned; rows of one class share a component. Null ids are kept, and are
never the least id unless the class has no other. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from .common import connected_components, materialize
from .idfilter import maybe_in
from .sets import PARITY_WORDS, digest_batches, prefix_batches, set_batches

EXTRA = 20  # one token in so many is added to the prefix for the shared-token filter


def prefix_width(n: int, percent: int) -> int:
    """Length of the extended prefix of a set of ``n``."""
    return 0 if n == 0 else min(n, n - -(-percent * n // 100) + 1 + n // EXTRA)


def _needed(n: Column, percent: int) -> Column:
    """Shared tokens that any partner needs inside the extended prefix: ``l`` of the smallest possible partner."""
    return F.lit(1) + F.floor(F.ceil(n * percent / 100) / EXTRA)


def _overlap(a: Column, b: Column, percent: int) -> Column:
    """Least overlap of two sets of these sizes that reaches the threshold."""
    return F.ceil((a + b) * percent / (100 + percent))


def _possible(na: Column, own_a: Column, nb: Column, own_b: Column, percent: int) -> Column:
    """Sizes are close enough, and neither set has more tokens of its own than the overlap leaves."""
    need = _overlap(na, nb, percent)
    return (F.least(na, nb) * 100 >= F.greatest(na, nb) * percent) & (na - own_a >= need) & (nb - own_b >= need)


def _meets(percent: int) -> Column:
    """Sides ``_a`` and ``_b`` of a bucket can be a pair, and the bucket's token stands in both sides' prefixes for this very
    pair: the prefix of sets of unlike or equal size is shorter than the one a set needs for its smallest partner."""
    need = _overlap(F.col("n_a"), F.col("n_b"), percent)
    near = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    return near & (F.col("pos_a") <= F.col("n_a") - F.col("own_a") - need) & (F.col("pos_b") <= F.col("n_b") - F.col("own_b") - need)


def _close(all_a: str, any_a: str, all_b: str, any_b: str, percent: int) -> Column:
    """No pair of members is ruled out by the bitmaps: ``all`` holds the bits that every member of a side has, ``any`` those
    that one has (both are the bitmap of a single set). Bits that surely differ are tokens that one set lacks."""
    cell = lambda c, i: F.get(F.col(c), F.lit(i))
    apart = sum((F.bit_count((cell(all_a, i).bitwiseAND(F.bitwise_not(cell(any_b, i)))).bitwiseOR(cell(all_b, i).bitwiseAND(F.bitwise_not(cell(any_a, i)))))
                 for i in range(PARITY_WORDS)), F.lit(0))
    return apart <= F.col("n_a") + F.col("n_b") - 2 * _overlap(F.col("n_a"), F.col("n_b"), percent)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of classes whose sets reach the threshold. A class with many pairs is split by AQE on the narrow side."""
    left = pairs.join(sets.select(F.col("cid").alias("a"), F.col("tokens").alias("x")), "a")
    both = left.join(sets.select(F.col("cid").alias("b"), F.col("tokens").alias("y")), "b")
    common = F.size(F.array_intersect("x", "y"))
    return both.where(common * 100 >= (F.size("x") + F.size("y") - common) * percent).select("a", "b")


def _classes(docs: DataFrame, k: int, percent: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, n, digest of the set) and classes (digest, doc: least id, component, least: its least id)."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    schema = "doc_id long, n long, digest binary, prefix array<long>"
    read = source.mapInArrow(prefix_batches(k, lambda n: prefix_width(n, percent)), schema)
    rows = materialize(read.withColumn("row", F.monotonically_increasing_id()), "shingle-rows")  # row numbers are fixed by the write
    classes = rows.groupBy("digest").agg(F.min("row").alias("cid"), F.min("doc_id").alias("doc"), F.max("n").alias("n"))

    firsts = rows.where("n > 0").groupBy("digest").agg(F.min("row").alias("cid"), F.max("n").alias("n"), F.min_by("prefix", "row").alias("prefix"))
    firsts = materialize(firsts, "prefixes")  # read twice below: for the counts and for the rows that they meet
    tokens = firsts.select("cid", F.col("n").cast("int").alias("n"), F.explode("prefix").alias("token"))
    left = _shared(tokens).groupBy("cid", "n").agg(F.count("*").alias("shared")).where(F.col("shared") >= _needed(F.col("n"), percent))
    left = materialize(left.select("cid"), "classes-left")
    sets = _whole_sets(source, left, classes, k)

    # whole sets: first among all classes left, then among those that can still have a partner
    counted = _shared(sets.select("cid", F.size("tokens").alias("n"), F.explode("tokens").alias("token"))).groupBy("cid", "n").agg(
        F.count("*").alias("shared")).where(F.col("shared") >= F.ceil(F.col("n") * percent / 100))
    sets = materialize(sets.join(counted.select("cid"), "cid", "left_semi"), "sets")
    listed = _shared(sets.select("cid", F.size("tokens").alias("n"), F.explode("tokens").alias("token"))).groupBy("cid", "n").agg(
        F.sort_array(F.collect_list(F.struct("df", "token"))).alias("t"))
    own = F.col("n") - F.size("t")
    joinable = F.size("t") - F.ceil(F.col("n") * percent / 100).cast("int") + 1
    members = listed.where(joinable >= 1).select("cid", "n", own.alias("own"), F.transform(F.slice("t", F.lit(1), joinable), lambda x: x["token"]).alias("prefix"))
    members = materialize(members.withColumn("key", F.md5(F.col("prefix").cast("string"))), "prefixes")
    groups = materialize(members.groupBy("n", "key").agg(F.min("cid").alias("gid")), "groups")  # same size and prefix: same ``own``
    members = materialize(members.hint("merge").join(groups, ["n", "key"]).drop("key"), "prefix-groups")

    buckets = members.where("gid = cid").select("gid", "n", "own", F.posexplode("prefix").alias("pos", "token"))
    star = _with_least(buckets).where(F.col("gid") != F.col("least.gid")).where(
        _possible(F.col("n"), F.col("own"), F.col("least.n"), F.col("least.own"), percent))
    first = star.select(F.least("least.gid", "gid").alias("a"), F.greatest("least.gid", "gid").alias("b")).unionByName(
        members.where("gid < cid").select(F.col("gid").alias("a"), F.col("cid").alias("b"))).distinct()
    first = materialize(first, "pairs")
    links = materialize(_verified(first, sets, percent), "links")
    reached = connected_components(links, "a", "b")

    placed = members.select("cid", "gid", "n", "own").join(reached.withColumnRenamed("node", "cid"), "cid", "left").select(
        "cid", "gid", "n", "own", F.coalesce("component", "cid").alias("comp")).join(sets.select("cid", "parity"), "cid")
    placed = materialize(placed, "placed")
    words = [F.get("parity", F.lit(i)) for i in range(PARITY_WORDS)]
    parts = placed.groupBy("gid", "comp").agg(F.array(*[F.bit_and(w) for w in words]).alias("all"), F.array(*[F.bit_or(w) for w in words]).alias("any"))
    parts = materialize(parts, "parts")
    spread = buckets.join(parts.select("gid", "comp"), "gid")
    open_ = spread.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("token")
    spread = spread.join(open_, "token").join(parts, ["gid", "comp"])
    sides = ("gid", "n", "own", "pos", "comp", "all", "any")
    x = spread.select("token", *[F.col(c).alias(f"{c}_a") for c in sides])
    y = spread.select("token", *[F.col(c).alias(f"{c}_b") for c in sides])
    crossed = x.join(y, (x["token"] == y["token"]) & (F.col("comp_a") < F.col("comp_b")) & _meets(percent)
                     & _close("all_a", "any_a", "all_b", "any_b", percent)).select("gid_a", "comp_a", "n_a", "gid_b", "comp_b", "n_b").distinct()

    def side(e: str) -> DataFrame:
        return placed.select(F.col("gid").alias(f"g_{e}"), F.col("comp").alias(f"c_{e}"), F.col("cid").alias(e), F.col("parity").alias(f"bits_{e}"))

    left = crossed.join(side("a"), (F.col("gid_a") == F.col("g_a")) & (F.col("comp_a") == F.col("c_a")))
    both = left.join(side("b"), (F.col("gid_b") == F.col("g_b")) & (F.col("comp_b") == F.col("c_b")) & _close("bits_a", "bits_a", "bits_b", "bits_b", percent))
    expanded = both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    rest = _verified(expanded.join(first, ["a", "b"], "left_anti"), sets, percent)
    found = connected_components(links.unionByName(rest), "a", "b")

    # ids: the least document of each component, brought back to every row of its classes
    named = classes.join(found.withColumnRenamed("node", "cid"), "cid", "left").select(
        "digest", "n", "doc", F.coalesce("component", "cid").alias("component"))
    roots = named.where("n > 0").groupBy("component").agg(F.min("doc").alias("least"))
    ids = named.where("n > 0").join(roots, "component").select("digest", "doc", "component", "least")
    return rows.select("doc_id", "n", "digest"), materialize(ids, "components")


def ngram_components(docs: DataFrame, k: int = 3, percent: int = 90, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and class_id (the least id with exactly this set) of each row."""
    rows, ids = _classes(docs, k, percent, id_col, text_col)
    own = lambda c: F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col(c))
    return rows.join(ids, "digest", "left").select("doc_id", F.col("n").alias("n_shingles"), own("least").alias("component_id"), own("doc").alias("class_id"))


def _shared(tokens: DataFrame) -> DataFrame:
    """Tokens (cid, n, token) that several classes hold, with their number of classes ``df``.

    Counts are added up in every task first and stored, so that both sides of the join come straight from a shuffle: AQE can
    split a token that many classes hold. Most tokens of one class leave by a bit table, sized by the tokens that are
    shared, before they are shuffled."""
    counts = materialize(tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1"), "token-counts")
    return maybe_in(tokens, "token", counts.select("token")).hint("merge").join(counts, "token")


def _with_least(buckets: DataFrame) -> DataFrame:
    """Each row of a bucket with ``least``, the bucket's group with the fewest tokens of its own; planned as ``_shared``."""
    least = buckets.groupBy("token").agg(F.min(F.struct("own", "gid", "n")).alias("least"), F.count("*").alias("df")).where("df > 1")
    return buckets.hint("merge").join(materialize(least.drop("df"), "bucket-least"), "token")


def _whole_sets(source: DataFrame, members: DataFrame, classes: DataFrame, k: int) -> DataFrame:
    """(cid, tokens, parity) of the classes that are left, from one more pass over their texts.

    A fixed-size bit table of ids lets other texts go before the shuffle; the join after it is exact."""
    left = classes.join(members.select("cid"), "cid", "left_semi").select("digest", "cid", "doc")
    left = materialize(left, "class-names")
    ids = left.select(F.col("doc").alias("doc_id")).distinct()
    texts = maybe_in(source.where("doc_id is not null"), "doc_id", ids).join(ids, "doc_id", "left_semi")
    nameless = source.where("doc_id is null")  # classes of rows without ids only
    sets = texts.unionByName(nameless).select("text").mapInArrow(set_batches(k), "digest binary, tokens array<long>, parity array<long>")
    return materialize(sets.join(left.select("digest", "cid"), "digest").dropDuplicates(["cid"]).select("cid", "tokens", "parity"), "sets")


def deduplicate(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component: a row with its least id (any one of them where rows repeat). Rows without words stay.

    Most rows stay, so the ids in question are looked up first: a fixed-size bit table lets all other rows pass where they
    are. Rows that it holds get their set's digest once more, find their component and are decided exactly."""
    rows, ids = _classes(docs, k, percent, id_col, text_col)
    found = rows.join(ids, "digest").select("doc_id", "component", "least")
    repeated = found.where(F.col("doc_id").eqNullSafe(F.col("least"))).groupBy("component", "doc_id").count().where("count > 1")
    asked = found.where(~F.col("doc_id").eqNullSafe(F.col("least"))).select("doc_id").unionByName(repeated.select("doc_id")).distinct()
    suspects, sure = maybe_in(docs, id_col, materialize(asked, "suspects"), split=True)
    # the caller's columns travel in one struct, so that none of the names used here can meet one of theirs
    others = [c for c in docs.columns if c != text_col]
    source = suspects.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("whole"), F.col(id_col).cast("long").alias("id"),
                             F.col(text_col).cast("binary").alias("text_"))
    marked = source.mapInArrow(digest_batches(k), StructType([*source.schema.fields, StructField("digest_", BinaryType())]))
    tied = marked.join(ids.select(F.col("digest").alias("digest_"), "component", "least"), "digest_", "left")
    chosen = tied.where("component is not null").where(F.col("id").eqNullSafe(F.col("least"))).dropDuplicates(["component"])
    kept = tied.where("component is null").unionByName(chosen)
    back = [F.col("text_").cast("string").alias(c) if c == text_col else F.col("whole").getField(c).alias(c) for c in docs.columns]
    return sure.unionByName(kept.select(*back))
