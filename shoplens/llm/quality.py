"""Quality classifier: a generalised additive model with pairwise interactions.

Each text becomes a few shape features. Shallow trees over one binned feature at a time are boosted in cycles, so every
feature ends with one lookup table of log-odds per bin; then the pairs of features with the largest gain on the
residual get small two-dimensional tables the same way. A score is the logistic of the intercept plus the looked-up bins,
added for whole Arrow batches.

The model is fitted on the driver from at most ``MAX_LABELLED`` labelled rows (a bounded sample by hash of the id);
their features are made by Spark. Only ids whose crc32 mod 3 is not 1 are learned from; language, source and id are
never features.

Null texts count as empty; empty texts get the score of their bins. Repeated rows are scored alike; null ids are never
held out and never learned from; extra columns are ignored (``keep_good`` keeps them); an empty table gives an empty
result. Without labels, or with one class only, the score is the (smoothed) share of label 1.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import sliced
from .idfilter import maybe_in

MAX_LABELLED = 30_000
FEATURES = ("log_bytes", "symbols", "upper", "bars", "bangs", "digits", "spaces", "controls", "log_words", "mean_word", "spread_word",
            "distinct_words", "marked_words", "capital_words", "log_lines", "same_lines", "mean_line", "packed", "high_bytes")
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,;:'\"()-!?|"]] = True
_UPPER, _LOWER, _DIGIT = slice(65, 91), slice(97, 123), slice(48, 58)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that no model learns from: crc32 of the id's text mod 3 is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def features(text: bytes | None) -> list[float]:
    """Shape of one whole text: shares of byte classes, word and line statistics, and how far it can be packed."""
    text = text or b""
    size = len(text)
    if not size:
        return [0.0] * len(FEATURES)
    at = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    upper, lower = int(at[_UPPER].sum()), int(at[_LOWER].sum())
    words = text.split()
    n = len(words)
    lengths = np.fromiter(map(len, words), np.int64, n) if n else np.zeros(1)
    ends = np.fromiter((w[-1] for w in words), np.uint8, n) if n else np.zeros(0, np.uint8)
    starts = np.fromiter((w[0] for w in words), np.uint8, n) if n else np.zeros(0, np.uint8)
    lines = text.split(b"\n")
    return [
        np.log1p(size), at[_SYMBOL].sum() / size, upper / max(1, upper + lower), at[124] / size, at[33] / size, at[_DIGIT].sum() / size,
        (at[32] + at[9]) / size, at[:9].sum() / size, np.log1p(n), float(lengths.mean()), float(lengths.std()),
        len(set(words)) / max(1, n), float((_SYMBOL[ends] | (ends == 33) | (ends == 124)).mean()) if n else 0.0,
        float(((starts >= 65) & (starts <= 90)).mean()) if n else 0.0, np.log1p(len(lines)), 1 - len(set(lines)) / len(lines), np.log1p(size / len(lines)),
        len(zlib.compress(text, 1)) / size, at[128:].sum() / size]


@dataclass
class Additive:
    """Intercept, cut points and a table per feature, and tables over pairs of coarser bins."""

    intercept: float = 0.0
    cuts: list = field(default_factory=list)
    tables: list = field(default_factory=list)
    pairs: list = field(default_factory=list)  # (i, j, cuts of i, cuts of j, table)

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.intercept)
        for f, (cuts, table) in enumerate(zip(self.cuts, self.tables, strict=True)):
            z += table[np.searchsorted(cuts, x[:, f], side="right")]
        for i, j, ci, cj, table in self.pairs:
            z += table[np.searchsorted(ci, x[:, i], side="right"), np.searchsorted(cj, x[:, j], side="right")]
        return 1 / (1 + np.exp(-z))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1], method="nearest"))


def _leaf(g, h, l2=5.0):
    return g / (h + l2)


def _gain(g, h, l2=5.0):
    return g * g / (h + l2)


def _step(g: np.ndarray, h: np.ndarray, leaves: int = 3) -> np.ndarray:
    """A shallow tree over ordered bins: cut greedily at the best gain until it has ``leaves`` leaves."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        best = (1e-9, None, None)
        for p, (a, b) in enumerate(parts):
            if b - a < 2:
                continue
            gl, hl = np.cumsum(g[a:b])[:-1], np.cumsum(h[a:b])[:-1]
            gain = _gain(gl, hl) + _gain(g[a:b].sum() - gl, h[a:b].sum() - hl) - _gain(g[a:b].sum(), h[a:b].sum())
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (gain[k], p, a + k + 1)
        if best[1] is None:
            break
        a, b = parts.pop(best[1])
        parts += [(a, best[2]), (best[2], b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = _leaf(g[a:b].sum(), h[a:b].sum())
    return out


def _step2(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Depth two over a grid: one cut along the first axis, then one along the second on either side."""
    best = (-1.0, 0)
    for a in range(1, g.shape[0]):
        worth = 0.0
        for side in (slice(0, a), slice(a, None)):
            gs, hs = g[side].sum(0), h[side].sum(0)
            gl, hl = np.cumsum(gs)[:-1], np.cumsum(hs)[:-1]
            worth += (_gain(gl, hl) + _gain(gs.sum() - gl, hs.sum() - hl)).max(initial=_gain(gs.sum(), hs.sum()))
        if worth > best[0]:
            best = (worth, a)
    out = np.zeros_like(g)
    for side in (slice(0, best[1]), slice(best[1], None)):
        if g[side].size:
            out[side] = _step(g[side].sum(0), h[side].sum(0), 2)
    return out


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 150, rate: float = 0.1, bins: int = 32, pairs: int = 4, pair_bins: int = 8) -> Additive:
    """Cyclic boosting of one table per feature, then of the strongest pairs, on the logistic loss."""
    share = (y.sum() + 1) / (len(y) + 2)
    model = Additive(float(np.log(share / (1 - share))), [], [], [])
    if len(np.unique(y)) < 2:
        return model
    cuts = [_edges(x[:, f], bins) for f in range(x.shape[1])]
    at = [np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(cuts)]
    tables = [np.zeros(len(c) + 1) for c in cuts]
    z = np.full(len(y), model.intercept)
    for _ in range(rounds):
        for f, (b, table) in enumerate(zip(at, tables, strict=True)):
            p = 1 / (1 + np.exp(-z))
            step = rate * _step(np.bincount(b, y - p, len(table)), np.bincount(b, p * (1 - p), len(table)))
            table += step
            z += step[b]
    model.cuts, model.tables = cuts, tables
    coarse = [_edges(x[:, f], pair_bins) for f in range(x.shape[1])]
    low = [np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(coarse)]

    def grid(i: int, j: int, z: np.ndarray):
        shape, cell, p = (len(coarse[i]) + 1, len(coarse[j]) + 1), low[i] * (len(coarse[j]) + 1) + low[j], 1 / (1 + np.exp(-z))
        n = shape[0] * shape[1]
        return cell, np.bincount(cell, y - p, n).reshape(shape), np.bincount(cell, p * (1 - p), n).reshape(shape)

    def worth(i: int, j: int) -> float:
        _, g, h = grid(i, j, z)
        return float(_gain(g, h).sum())

    ranked = sorted(((worth(i, j), i, j) for i in range(x.shape[1]) for j in range(i)), reverse=True)[:pairs]
    chosen = [(i, j, np.zeros((len(coarse[i]) + 1, len(coarse[j]) + 1))) for _, i, j in ranked]
    for _ in range(rounds // 3):
        for i, j, table in chosen:
            cell, g, h = grid(i, j, z)
            step = rate * _step2(g, h)
            table += step
            z += step.ravel()[cell]
    model.pairs = [(i, j, coarse[i], coarse[j], t) for i, j, t in chosen]
    return model


def _matrix(texts: pa.Array) -> np.ndarray:
    rows = [features(t) for t in texts.to_pylist()]
    return np.round(np.array(rows, dtype=float).reshape(len(rows), len(FEATURES)), 9)


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for part in sliced(whole, "text")):
        x = _matrix(batch.column("text"))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(x[:, f]) for f in range(x.shape[1])]], names=["doc_id", *FEATURES])


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, label) of at most about ``limit`` labelled rows that may be learned from, by hash of the id. Texts of
    other rows do not move: a bit table of the sampled ids goes before the exact join."""
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).alias("label")).where(
        F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out())
    rows = usable.count()
    if rows > limit:
        usable = usable.where(F.pmod(F.xxhash64(F.col("doc_id"), F.lit(17)), F.lit(1_000_000)) < int(1_000_000 * limit / rows))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text")).where("doc_id is not null")
    return maybe_in(texts, "doc_id", usable.select("doc_id").distinct()).join(usable, "doc_id")


def fit_on(docs: DataFrame, labels: DataFrame, label: str = "quality", limit: int = MAX_LABELLED, id_col: str = "doc_id",
           text_col: str = "text") -> Additive:
    sample = labelled_sample(docs, labels, label, limit, id_col, text_col)
    made = sample.select("doc_id", "text").mapInArrow(_feature_batches, "doc_id long, " + ", ".join(f"{f} double" for f in FEATURES))
    known = made.join(sample.select("doc_id", "label").distinct(), "doc_id").toArrow()
    x = np.column_stack([known.column(f).to_numpy() for f in FEATURES]) if known.num_rows else np.zeros((0, len(FEATURES)))
    y = known.column("label").to_numpy().astype(float) if known.num_rows else np.zeros(0)
    order = np.lexsort((y, *x.T, known.column("doc_id").to_numpy())) if known.num_rows else []
    return fit(x[order], (y[order] > 0).astype(float))


def score_batches(model: Additive) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in sliced(whole, "text")):
            score = model.scores(_matrix(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(score)], names=["doc_id", "held_out", "score"])

    return run


def quality_scores(docs: DataFrame, model: Additive, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted of each row."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).cast("binary").alias("text"))
    scored = rows.mapInArrow(score_batches(model), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def keep_good(docs: DataFrame, model: Additive, text_col: str = "text") -> DataFrame:
    """The rows that are not rejected, with all their columns."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in sliced(whole, at)):
            yield batch.filter(pa.array(model.scores(_matrix(batch.column(at).cast(pa.binary()))) >= 0.5))

    return docs.mapInArrow(run, docs.schema)
