"""Alignment of two tokenizers by sparse products of incidence matrices.

A document is written as space + text and tokenised by a byte-level BPE (A) and a piece model with byte fallback (B). Where
the tokens of both sides spell exactly these bytes, each side is a *token-byte incidence matrix*: a row for a token, a
column for a byte. Matrices are in compressed sparse rows built here from token lengths, and products are taken row by row
(Gustavson): row i of X·Y is the sum of the rows of Y that row i of X names. A's file is read as ranks where its merges
stand in the order of its ids (checked on loading), which gives the same ids faster; else the file's own library encodes.

1. ``A·Bᵀ`` over bytes gives the *overlap links* with their number of shared bytes. In row order, a link whose two tokens
   are both new begins a *group*: there, and only there, both sides ended on one byte.
2. The *group incidences* (rows: the distinct A ids of a document, columns: groups, values: occurrences; and the same for B)
   give ``G_A·G_Bᵀ``: for every id pair of a document the number of token pairs that share a group, the *shared-group links*.
   It is taken in blocks of rows, so a group of very many tokens needs bounded memory, and id pairs stay counted.
3. Corpus counts: each document adds one to each of its id pairs, combined in every task. Counts go back to the documents'
   pairs in two ways: pairs of the most frequent powers of two, at most ``FREQUENT`` of them, are broadcast (bounded by
   construction), all others are shuffled and joined. Both ways are exact; most occurrences fall to the first.

Texts that are null or empty, or whose tokens on either side do not spell space + text (the piece model rewrites some
characters), have no tokens: zeros and an empty digest. Special tokens inside texts are plain text. Repeated rows and
repeated ids are documents of their own and count each. Very long texts are processed whole. Extra columns are ignored,
and an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize

SLICE_CHARS = 1 << 20  # texts that are tokenised at once hold about so many characters (or are a single text)
EXPANDED = 1 << 21  # entries that a block of row products expands to, at most or in a single row
FREQUENT = 1 << 19  # id pairs whose counts are broadcast
SPACE = "▁"
REMEMBERED = 300_000  # units that a worker remembers before it starts anew (memory only, no effect on results)
UNITS = re.compile(" +[^ ]*")
LONG_RUN = re.compile(r"\s{10000}")


# ---------------------------------------------------------------- sparse matrices
@dataclass
class Csr:
    """Rows ``ptr[i]:ptr[i + 1]`` of ``cols`` with ``values`` (None: ones)."""

    ptr: np.ndarray
    cols: np.ndarray
    values: np.ndarray | None = None

    @property
    def rows(self) -> int:
        return len(self.ptr) - 1


def tiling(lengths: np.ndarray) -> Csr:
    """Incidence of tokens that lie one after another: row i holds the next ``lengths[i]`` columns."""
    ptr = np.concatenate([[0], np.cumsum(lengths)])
    return Csr(ptr, np.arange(ptr[-1], dtype=np.int32))


def transposed(x: Csr, columns: int) -> Csr:
    rows = np.repeat(np.arange(x.rows, dtype=np.int32), np.diff(x.ptr))
    ptr = np.concatenate([[0], np.cumsum(np.bincount(x.cols, minlength=columns))])
    if np.all(x.cols[1:] >= x.cols[:-1]):  # a tiling: its entries are in column order already
        return Csr(ptr, rows, x.values)
    order = np.argsort(x.cols, kind="stable")
    return Csr(ptr, rows[order], None if x.values is None else x.values[order])


def from_entries(row: np.ndarray, col: np.ndarray, rows: int, width: int) -> Csr:
    """Matrix of (row, column) entries; entries that repeat are counted. ``width`` exceeds every column."""
    key, count = np.unique(row.astype(np.int64) * width + col, return_counts=True)
    ptr = np.concatenate([[0], np.cumsum(np.bincount(key // width, minlength=rows))])
    return Csr(ptr, key % width, count)


def row_products(x: Csr, y: Csr, width: int, limit: int = EXPANDED) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Entries (row, column, value) of x·y in row order, block by block of rows. ``width`` exceeds every column of y."""
    size = np.diff(y.ptr)
    upto = np.concatenate([[0], np.cumsum(size[x.cols])])  # expanded entries before each entry of x
    begin = 0
    while begin < x.rows:
        end = int(np.searchsorted(upto[x.ptr], upto[x.ptr[begin]] + limit, side="right")) - 1
        end = min(max(end, begin + 1), x.rows)
        lo, hi = x.ptr[begin], x.ptr[end]
        named = x.cols[lo:hi]
        counts = size[named]
        row = np.repeat(np.arange(begin, end) * width, np.diff(x.ptr[begin:end + 1]))
        if np.all(counts == 1):  # every named row of y has one entry
            at = y.ptr[named]
        else:
            at = np.arange(upto[hi] - upto[lo]) + np.repeat(y.ptr[named] - (upto[lo:hi] - upto[lo]), counts)
            row = np.repeat(row, counts)
        key = row + y.cols[at]
        value = None if x.values is None and y.values is None else np.repeat(x.values[lo:hi], counts) if x.values is not None else np.ones(len(at), np.int64)
        if y.values is not None:
            value = value * y.values[at]
        if np.any(key[1:] < key[:-1]):
            order = np.argsort(key, kind="stable")
            key, value = key[order], None if value is None else value[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        if value is None:
            total = np.diff(np.append(first, len(key)))
        else:
            total = np.add.reduceat(value, first) if len(first) else value
        key = key[first]
        rows = key // width
        yield rows, key - rows * width, total
        begin = end


# ---------------------------------------------------------------- tokenizers
def byte_level_table() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: printable characters stand for themselves, the other bytes, in order, for
    the characters from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


class Side:
    """Bytes, lengths and decimal digits of a tokenizer's ids."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.length = np.array([len(t) for t in tokens], np.int64)

    def spells(self, ids: list[int], wanted: bytes) -> bool:
        return b"".join(map(self.tokens.__getitem__, ids)) == wanted


#: How byte-level vocabularies cut a text into words (a fixed value of the tokenizer's format).
WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def ranked(byte_json: bytes):
    """The byte-level BPE as a rank encoder, several times as fast, or None where the file's merges are not in the order of
    its ids (ranks would then merge otherwise) or its words are cut in another way."""
    import tiktoken

    spec = json.loads(byte_json)
    model, cut = spec["model"], spec.get("pre_tokenizer") or {}
    plain = model["type"] == "BPE" and not spec.get("normalizer") and not model.get("dropout") and not model.get("ignore_merges")
    if not plain or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True):
        return None
    special = {t["content"] for t in spec.get("added_tokens", [])}
    to_byte = byte_level_table()
    ranks = {bytes(to_byte[c] for c in name): n for name, n in model["vocab"].items() if name not in special}
    merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    if len(merged) + 256 != len(ranks) or any(a >= b for a, b in itertools.pairwise(merged)) or max(ranks[bytes([b])] for b in range(256)) >= merged[0]:
        return None
    return tiktoken.Encoding("byte-level", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})


class Pair:
    """Both tokenizers, loaded in a task from their files' bytes."""

    def __init__(self, byte_json: bytes, piece_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one thread: Spark runs the tasks
        import sentencepiece
        import tokenizers

        self.first = tokenizers.Tokenizer.from_str(byte_json.decode("utf-8"))
        self.first.encode_special_tokens = True
        self.ranked = ranked(byte_json)
        self.second = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        to_byte = byte_level_table()
        names = self.first.get_vocab(with_added_tokens=True)
        by_id = [b""] * (max(names.values()) + 1)
        for name, n in names.items():
            by_id[n] = bytes(to_byte[c] for c in name) if all(c in to_byte for c in name) else name.encode("utf-8")
        self.a = Side(by_id)
        self.known: dict[str, bytes | None] = {}  # units of B as ids; None where the model rewrites them
        pieces = []
        for n in range(self.second.get_piece_size()):
            piece = self.second.id_to_piece(n)
            pieces.append(bytes([int(piece[3:5], 16)]) if self.second.is_byte(n) else piece.replace(SPACE, " ").encode("utf-8"))
        self.b = Side(pieces)
        own = [self.second.id_to_piece(n) for n in range(self.second.get_piece_size()) if not (self.second.is_control(n) or self.second.is_unknown(n))]
        self.by_unit = not any(SPACE in piece.lstrip(SPACE) for piece in own)
        digits = max(len(str(len(s.tokens))) for s in (self.a, self.b))
        ids = np.arange(max(len(self.a.tokens), len(self.b.tokens)))
        self.size = np.char.str_len(ids.astype(str)).astype(np.int64)
        self.shown = np.zeros((len(ids), digits + 1), np.uint8)  # decimal digits from the left, room for a mark
        for place in range(digits):
            held = place < self.size
            self.shown[held, place] = 48 + ids[held] // 10 ** (self.size[held] - 1 - place) % 10

    def _first(self, spaced: list[str]) -> list[np.ndarray]:
        """Ids of A. A vocabulary with all single bytes spells whatever it is given, so ranks need no look at the bytes."""
        slow = [n for n, t in enumerate(spaced) if self.ranked is None or LONG_RUN.search(t)]  # the rank encoder's word rule recurses in such runs
        out = [self.ranked.encode_to_numpy(t, disallowed_special=()) for t in spaced] if not slow else [
            None if n in set(slow) else self.ranked.encode_to_numpy(t, disallowed_special=()) for n, t in enumerate(spaced)]
        for n, e in zip(slow, self.first.encode_batch_fast([spaced[n] for n in slow], add_special_tokens=False) if slow else (), strict=True):
            out[n] = np.array(e.ids if self.a.spells(e.ids, spaced[n].encode("utf-8")) else [], np.uint32)
        return out

    def _second(self, texts: list[str], spaced: list[str]) -> list[np.ndarray]:
        """Ids of B. No piece joins two units (spaces and what follows them up to the next space), so units are encoded once
        and remembered; a text with a unit that the model rewrites is encoded whole."""
        if not self.by_unit:
            whole, cut = list(range(len(texts))), [[] for _ in texts]
        else:
            cut = [UNITS.findall(t) for t in spaced]
            new = list(set().union(*cut).difference(self.known)) if cut else []
            if len(self.known) + len(new) > REMEMBERED:
                self.known.clear()
                new = list(set().union(*cut))
            lone = [u for u in new if u == " "]  # the model's own mark before an empty text would be dropped
            for u, ids in zip(new, self.second.encode([u[1:] for u in new], num_threads=1), strict=True):
                self.known[u] = np.array(ids, np.uint32).tobytes() if self.b.spells(ids, u.encode("utf-8")) else None
            for u in lone:
                self.known[u] = None
            parts = [list(map(self.known.__getitem__, units)) for units in cut]
            whole = [n for n, p in enumerate(parts) if None in p]
        out = [np.zeros(0, np.uint32)] * len(texts)
        if self.by_unit:
            odd = set(whole)
            out = [out[n] if n in odd else np.frombuffer(b"".join(p), np.uint32) for n, p in enumerate(parts)]
        for n, ids in zip(whole, self.second.encode([texts[n] for n in whole], num_threads=1) if whole else (), strict=True):
            out[n] = np.array(ids if self.b.spells(ids, spaced[n].encode("utf-8")) else [], np.uint32)
        return out

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both sides; none for texts that either side does not spell."""
        spaced = [" " + t for t in texts]
        a, b = self._first(spaced), self._second(texts, spaced)
        for n, text in enumerate(texts):
            if not text or not len(a[n]) or not len(b[n]):
                a[n] = b[n] = np.zeros(0, np.uint32)
        return a, b


# ---------------------------------------------------------------- one slice of texts
@dataclass
class Aligned:
    """Texts of a slice: token counts, groups, overlap links, digests; and the id pairs of its documents."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_overlaps: np.ndarray
    digests: list[str]
    pairs: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # blocks of (document, pair code, links), in document order


def _per_text(owner: np.ndarray, texts: int) -> np.ndarray:
    return np.bincount(owner, minlength=texts).astype(np.int64)


def align(pair: Pair, texts: list[str], bits: int) -> Aligned:
    """Products of a slice: its texts lie one after another, so no link crosses from one to the next."""
    listed_a, listed_b = pair.encode(texts)
    count = len(texts)
    n_a, n_b = (np.array([len(x) for x in side], np.int64) for side in (listed_a, listed_b))
    ids_a, ids_b = (np.concatenate(side).astype(np.int32) if side else np.zeros(0, np.int32) for side in (listed_a, listed_b))
    text_a = np.repeat(np.arange(count), n_a)
    if not len(ids_a):
        zero = np.zeros(count, np.int64)
        return Aligned(n_a, n_b, zero, zero, [""] * count, [])

    bytes_a, bytes_b = tiling(pair.a.length[ids_a]), tiling(pair.b.length[ids_b])
    of_byte = transposed(bytes_b, len(bytes_b.cols))
    links = list(row_products(bytes_a, of_byte, len(ids_b)))
    left, right = (np.concatenate([block[n] for block in links]) for n in (0, 1))
    opens = np.concatenate([[True], (left[1:] != left[:-1]) & (right[1:] != right[:-1])])
    group = np.cumsum(opens, dtype=np.int32) - np.int32(1)
    group_a, group_b = np.zeros(len(ids_a), np.int32), np.zeros(len(ids_b), np.int32)
    group_a[left], group_b[right] = group, group
    groups = int(group[-1]) + 1
    begin_a, begin_b = (np.concatenate([[0], np.cumsum(np.bincount(g, minlength=groups))]) for g in (group_a, group_b))
    owner = text_a[begin_a[:-1]]

    code = text_a << bits | ids_a.astype(np.int64)  # an A id of one document
    names, row = np.unique(code, return_inverse=True)
    g_a = from_entries(row, group_a, len(names), groups)
    g_b = from_entries(group_b, ids_b, groups, len(pair.b.tokens))
    made = []
    for at, other, value in row_products(g_a, g_b, len(pair.b.tokens)):
        name = names[at]
        made.append((name >> bits, (name & ((1 << bits) - 1)) << bits | other, value))
    return Aligned(n_a, n_b, _per_text(owner, count), _per_text(text_a[left], count),
                   _digests(pair, ids_a, ids_b, group_a, group_b, begin_a, begin_b, n_a + n_b), made)


def _digests(pair: Pair, ids_a, ids_b, group_a, group_b, begin_a, begin_b, tokens) -> list[str]:
    """SHA-256 of ``a1,a2|b1;a3|b2,b3`` of each text, its groups in order; empty without tokens."""
    at_a = np.arange(len(ids_a)) + begin_b[group_a]
    at_b = np.arange(len(ids_b)) + begin_a[group_b + 1]
    ids = np.empty(len(ids_a) + len(ids_b), np.int32)
    ids[at_a], ids[at_b] = ids_a, ids_b
    mark = np.full(len(ids), ord(","), np.uint8)
    mark[at_a[begin_a[1:] - 1]] = ord("|")
    mark[at_b[begin_b[1:] - 1]] = ord(";")
    size = pair.size[ids]
    cells = pair.shown[ids]
    cells[np.arange(len(ids)), size] = mark
    text = cells[np.arange(cells.shape[1]) <= size[:, None]].tobytes()
    last = np.concatenate([[0], np.cumsum(size + 1)])[np.concatenate([[0], np.cumsum(tokens)])]
    return [hashlib.sha256(text[a:b - 1]).hexdigest() if b > a else "" for a, b in zip(last[:-1], last[1:], strict=True)]


# ---------------------------------------------------------------- Spark
_SCHEMA = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_overlaps long, n_links long, groups_sha256 string, "
           "pairs array<long>, links array<long>")
_FACTS = ("doc_id", "n_a", "n_b", "n_groups", "n_overlaps", "groups_sha256")


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    a = size = 0
    for n, t in enumerate(texts):
        size += len(t)
        if size >= SLICE_CHARS:
            yield a, n + 1
            a, size = n + 1, 0
    if a < len(texts):
        yield a, len(texts)


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, values)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(values) if values else np.zeros(0, np.int64), pa.int64()))


def _batches(shared, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = Pair(*shared.value)
        none = np.zeros(0, np.int64)
        for batch in batches:
            column, rows, ids = batch.column("text"), batch.column("row").to_numpy(), batch.column("doc_id")
            sizes = column.to_pylist()
            for lo, hi in _slices(sizes):
                texts = sizes[lo:hi]
                sizes[lo:hi] = [""] * (hi - lo)
                got = align(pair, texts, bits)
                # rows of the slice, each with the first block of its pairs; a document over several blocks gets rows more
                owner = [np.arange(hi - lo)]
                pairs, links = [none] * (hi - lo), [none] * (hi - lo)
                for doc, code, value in got.pairs:
                    cut = np.flatnonzero(np.diff(doc)) + 1
                    first = doc[np.concatenate([[0], cut])] if len(doc) else doc
                    for n, c, v in zip(first, np.split(code, cut), np.split(value, cut), strict=False):
                        if len(pairs[n]):
                            owner.append(np.array([n]))
                            pairs.append(c)
                            links.append(v)
                        else:
                            pairs[n], links[n] = c, v
                at = np.concatenate(owner)
                main = np.arange(len(at)) < hi - lo  # facts stand on the first row of a document only
                fact = lambda x: pa.array(np.where(main, np.asarray(x)[at], 0), pa.int64())  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[lo:hi][at]), ids.slice(lo, hi - lo).take(pa.array(at)), fact(got.n_a), fact(got.n_b), fact(got.n_groups), fact(got.n_overlaps),
                     pa.array([int(v.sum()) for v in links], pa.int64()), pa.array([got.digests[n] if m else None for n, m in zip(at, main, strict=True)], pa.string()),
                     _lists(pairs), _lists(links)],
                    names=["row", "doc_id", "n_a", "n_b", "n_groups", "n_overlaps", "n_links", "groups_sha256", "pairs", "links"])

    return run


def default_files() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def alignments(docs: DataFrame, byte_path: str | None = None, piece_path: str | None = None, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Stored rows (row, doc_id, n_a, n_b, n_groups, n_overlaps, n_links, groups_sha256, pairs, links): ``pairs`` are the codes
    ``a << 20 | b`` of a document's linked ids in order, ``links`` their numbers. A document with very many pairs has further rows;
    its facts stand on the first one."""
    files = []
    for path in (byte_path or default_files()[0], piece_path or default_files()[1]):
        with open(path, "rb") as f:  # two vocabulary files of a few MB, read on the driver and shipped
            files.append(f.read())
    shared = docs.sparkSession.sparkContext.broadcast(tuple(files))
    source = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                         F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return materialize(source.mapInArrow(_batches(shared, PAIR_BITS), _SCHEMA), "alignments", {"parquet.writer.version": "v2"})


PAIR_BITS = 20


def pair_counts(spark: SparkSession, aligned: DataFrame) -> DataFrame:
    """Stored (pair, n, best): the documents that hold an id pair linked, and whether no pair of its A id has more."""
    counts = materialize(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")), "pair-counts")
    side = F.shiftright("pair", PAIR_BITS).alias("a")
    most = counts.groupBy(side).agg(F.max("n").alias("most"))
    return materialize(counts.select("*", side).join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pair-counts")


def _frequent(counts: DataFrame, limit: int) -> int:
    """Least power of two such that at most ``limit`` pairs are in that many documents."""
    levels = counts.groupBy(F.floor(F.log2("n")).cast("int").alias("level")).count().collect()  # 63 rows at most
    held, least = 0, 62
    for r in sorted(levels, key=lambda r: -r["level"]):
        held += r["count"]
        if held > limit:
            break
        least = r["level"]
    return 1 << least


def alignment_report(docs: DataFrame, limit: int = FREQUENT, **options) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, n_overlaps of each row."""
    aligned = alignments(docs, **options)
    counts = pair_counts(docs.sparkSession, aligned)
    least = _frequent(counts, limit)
    cells = aligned.where(F.size("pairs") > 0).select("row", F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("links").alias("links"))))
    looked = cells.join(F.broadcast(counts.where(F.col("n") >= least)), "pair", "left")
    rare = cells.join(F.broadcast(counts.where(F.col("n") >= least).select("pair")), "pair", "left_anti").join(
        counts.where(F.col("n") < least), "pair")
    sums = [F.sum(F.col("links") * F.col("n")).alias("count_sum"), F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best")]
    found = looked.where("n is not null").groupBy("row").agg(*sums)
    if least > 1:
        found = found.unionByName(rare.groupBy("row").agg(*sums))
    facts = aligned.select("row", *_FACTS, "n_links", F.lit(0).cast("long").alias("count_sum"), F.lit(0).cast("long").alias("n_best"))
    sides = facts.unionByName(found, allowMissingColumns=True)
    sums = ("n_a", "n_b", "n_groups", "n_overlaps", "n_links", "n_best", "count_sum")
    whole = sides.groupBy("row").agg(F.max("doc_id").alias("doc_id"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums],
                                     F.max("groups_sha256").alias("groups_sha256"))
    return whole.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps")
