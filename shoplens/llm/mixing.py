"""Mixing sources to target weights with soft membership.

A classifier learned from a labelled table gives each document a posterior over domains. Document rates r >= 0 are fitted so
that the expected domain token totals, sum of r * tokens * posterior, match the targets: least squares by projected
gradient, starting at rate 1. Each step is one aggregate over a narrow written table (tokens and posteriors); the
driver sees one total per domain and adds one small vector, and a document's rate is the fold of those vectors over
its posterior, so rates are never stored between steps. The residual is weighted by the inverse of the domains'
token Gram matrix over the documents that are not clipped, and a step that makes the residual larger is taken back and
halved, so the fit only ever improves on rate 1.

The classifier is a softmax over the presence of the ``WORDS`` terms whose document shares differ most between domains (terms:
words without the marks around them, the marks that end words, and whether words are in capitals), learned from at most ``MAX_LABELLED`` labelled rows (by hash of the id; ids with crc32 mod 3 equal to 1 are left out).

Null texts count as empty; documents without words get the posterior of the intercepts and no tokens, and their rate.
Rows with a null domain are not learned from. Without labelled rows there is one domain and every rate is 1. A domain
whose target cannot be reached (no document leans to it) keeps its distance, and ``Mix.missed`` names it. Repeated rows and
null ids are rated like any others (the draw of a row's fraction hashes id and text); extra columns are kept by ``mixed`` and ignored by the report; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, materialize, sliced
from .quality import labelled_sample

MAX_LABELLED = 12_000
REMEMBERED = 100_000  # words that a worker remembers before it starts anew (memory only, no effect on results)
WORDS = 256
LEAST_TEXTS = 8  # a term must be in so many labelled texts
STEPS, TOLERANCE = 30, 1e-5  # of all tokens
RIDGE = 1e-6  # of all tokens; keeps the metric sound where a domain has next to none


MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum())


def terms_of(word: bytes) -> tuple[bytes, ...]:
    """Terms of a word: its lower-cased core, the marks behind it, and a sign for three or more capitals."""
    bare = word.rstrip(MARKS)
    core = bare.lstrip(MARKS)
    out = (core.lower(),) if core else ()
    if len(bare) < len(word):
        out += (b"\x00" + word[len(bare):],)
    if len(core) > 2 and core.isupper():
        out += (b"\x00A",)
    return out


class TermIndex(dict):
    """Word -> places of its known terms, remembered (memory only, no effect on results)."""

    def __init__(self, known: dict[bytes, int]) -> None:
        super().__init__()
        self.known = known

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = tuple(self.known[t] for t in terms_of(word) if t in self.known)
        return found


@dataclass
class Domains:
    names: list
    words: dict
    weights: np.ndarray  # (words + 1) x domains, the last row the intercepts

    def posteriors(self, texts: list[bytes | None], index: TermIndex | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(tokens, posteriors) of whole texts: words are runs without ASCII white space. A task keeps its ``index``."""
        tokens = np.zeros(len(texts), np.int64)
        z = np.repeat(self.weights[-1][None, :], len(texts), 0)
        index = TermIndex(self.words) if index is None else index
        for n, text in enumerate(texts):
            words = text.split() if text else []
            tokens[n] = len(words)
            at = set().union(*map(index.__getitem__, set(words)))
            if at:
                z[n] += self.weights[sorted(at)].sum(0)
        z = np.exp(z - z.max(1, keepdims=True))
        return tokens, np.round(z / z.sum(1, keepdims=True), 6)


def _softmax_fit(x: np.ndarray, y: np.ndarray, domains: int, steps: int = 150, ridge: float = 1e-3) -> np.ndarray:
    """Accelerated gradient descent on the mean log loss; x holds 0/1 columns and a last column of ones."""
    w = np.zeros((x.shape[1], domains))
    w[-1] = np.log((np.bincount(y, minlength=domains) + 1) / (len(y) + domains))
    target = np.eye(domains, dtype=np.float32)[y]
    rate = 4.0 / max(1.0, float((x.sum(1) ** 1).mean()))
    ahead, before = w.copy(), w.copy()
    for n in range(steps):
        z = x @ ahead.astype(np.float32)
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        grad = x.T @ (p - target) / len(y) + ridge * np.r_[ahead[:-1], np.zeros((1, domains))]
        w = ahead - rate * grad
        ahead = w + n / (n + 3) * (w - before)
        before = w
    return np.round(w, 9)


def fit_domains(docs: DataFrame, labels: DataFrame, domain_col: str = "domain", id_col: str = "doc_id", text_col: str = "text") -> Domains:
    sample = labelled_sample(docs, labels, domain_col, MAX_LABELLED, id_col, text_col).select("doc_id", "label", "text")
    sample = materialize(sample, "labelled")
    names = [r[0] for r in sample.select("label").distinct().orderBy("label").collect()]
    if len(names) < 2:
        return Domains(names or ["all"], {}, np.zeros((1, max(1, len(names)))))
    words = sample.mapInArrow(_text_words, "label string, word binary").groupBy("label", "word").count()
    texts = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    seen = words.groupBy("word").agg(F.sum("count").alias("n"), F.map_from_entries(F.collect_list(F.struct("label", "count"))).alias("by"))
    shares = {g: n / sum(texts.values()) for g, n in sorted(texts.items())}
    score = sum(((F.coalesce(F.try_element_at("by", F.lit(g)), F.lit(0)) - F.col("n") * s) ** 2 / (F.col("n") * s) for g, s in shares.items()), F.lit(0.0))
    best = seen.where(F.col("n") >= LEAST_TEXTS).select("word", score.alias("score")).orderBy(F.desc("score"), "word").limit(WORDS)
    chosen = sorted(bytes(r["word"]) for r in best.collect())
    known = {w: n for n, w in enumerate(chosen)}

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = TermIndex(known)
        for batch in (part for whole in batches for part in sliced(whole, "text")):
            at = [sorted(set().union(*map(index.__getitem__, set((t or b"").split())))) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(at, pa.list_(pa.int32()))], names=["doc_id", "label", "at"])

    rows = sample.mapInArrow(present, "doc_id long, label string, at array<int>").toArrow().to_pylist()
    rows.sort(key=lambda r: (r["doc_id"], r["label"], r["at"]))
    x = np.zeros((len(rows), len(chosen) + 1), np.float32)
    x[:, -1] = 1
    for n, r in enumerate(rows):
        x[n, r["at"]] = 1
    y = np.array([names.index(r["label"]) for r in rows])
    return Domains(names, known, _softmax_fit(x, y, len(names)))


def _text_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
            words = sorted(set().union(*map(terms_of, set((text or b"").split()))))
            yield pa.RecordBatch.from_arrays([pa.array([label] * len(words), pa.string()), pa.array(words, pa.binary())], names=["label", "word"])


@dataclass
class Mix:
    domains: Domains
    steps: list  # one vector per gradient step
    targets: list  # tokens per domain
    reached: list  # expected tokens per domain at the end

    @property
    def missed(self) -> dict[str, float]:
        """Domains whose expected tokens stay off their target by more than the tolerance, with the difference."""
        off = [(n, r - t) for n, r, t in zip(self.domains.names, self.reached, self.targets, strict=True)]
        return {n: d for n, d in off if abs(d) >= TOLERANCE * max(1.0, sum(self.targets))}

    def rate(self, p: np.ndarray) -> np.ndarray:
        """Rates of posteriors (rows x domains): the gradient steps folded with the projection on r >= 0."""
        r = np.ones(len(p))
        for v in self.steps:
            r = np.maximum(0.0, r - p @ np.asarray(v))
        return r


def _rate_column(steps: list, count: int) -> Column:
    r = F.lit(1.0)
    for v in steps:
        r = F.greatest(F.lit(0.0), r - sum((F.col(f"p{g}") * float(v[g]) for g in range(count)), F.lit(0.0)))
    return r


def _posterior_table(docs: DataFrame, domains: Domains, id_col: str, text_col: str) -> DataFrame:
    count = len(domains.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = TermIndex(domains.words)
        for batch in (part for whole in batches for part in sliced(whole, "text")):
            tokens, p = domains.posteriors(batch.column("text").to_pylist(), index)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(tokens), batch.column("chance"), *[pa.array(p[:, g]) for g in range(count)]],
                                             names=["doc_id", "tokens", "chance", *[f"p{g}" for g in range(count)]])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"), _chance(id_col, text_col).alias("chance"))
    return materialize(source.mapInArrow(run, "doc_id long, tokens long, chance double, " + ", ".join(f"p{g} double" for g in range(count))), "posteriors")


def _chance(id_col: str, text_col: str) -> Column:
    """The draw in [0, 1) that decides about the fraction of a row's rate: a hash of its id and text, the same in the report
    and in the mixed rows. Rows that repeat both share it; rows with a null id differ by their texts."""
    return F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.col(text_col).cast("string"), F.lit(9)), F.lit(1 << 30)) / float(1 << 30)


def fit_mix(table: DataFrame, domains: Domains, weights: dict[str, float]) -> Mix:
    """Projected gradient over ``table``. ``weights`` are shares of all tokens; domains that it does not name share what
    is left in proportion to their tokens. Sums are rounded to 1e-6 of a token, so partitions do not show."""
    count = len(domains.names)
    exact = lambda c: F.sum(c.cast("decimal(38,6)"))
    pairs = [(a, b) for a in range(count) for b in range(a, count)]
    first = table.agg(exact(F.col("tokens")), *[exact(F.col("tokens") * F.col(f"p{g}")) for g in range(count)],
                      *[exact(F.col("tokens") * F.col(f"p{a}") * F.col(f"p{b}")) for a, b in pairs]).first()
    total = float(first[0] or 0)
    if not total:
        return Mix(domains, [], [0.0] * count, [0.0] * count)
    have = np.array([float(x) for x in first[1:1 + count]])
    gram = np.zeros((count, count))
    for (a, b), x in zip(pairs, first[1 + count:], strict=True):
        gram[a, b] = gram[b, a] = float(x)
    named = {g: weights[n] for g, n in enumerate(domains.names) if n in weights}
    rest = max(0.0, 1 - sum(named.values()))
    others = sum(have[g] for g in range(count) if g not in named)
    share = np.array([named.get(g, rest * have[g] / others if others else 0.0) for g in range(count)])
    targets = share / max(share.sum(), 1e-12) * total
    steps, now, damp = [], have, 1.0
    for _ in range(STEPS):
        residual = (now - targets) / total
        size = np.abs(residual).max()
        if size < TOLERANCE or damp < 1e-3:
            break
        # the residual's metric is the Gram matrix of the documents whose rate is not at its bound: a full step would solve
        # the problem if no further rate were clipped. A step that makes things worse is taken back and halved.
        direction = np.linalg.pinv(gram / total + RIDGE * np.eye(count)) @ residual
        tried = [*steps, np.round(damp * direction, 12).tolist()]
        sums = table.select("*", _rate_column(tried, count).alias("r")).agg(
            *[exact(F.col("tokens") * F.col(f"p{g}") * F.col("r")) for g in range(count)],
            *[exact(F.when(F.col("r") > 0, F.col("tokens") * F.col(f"p{a}") * F.col(f"p{b}")).otherwise(0.0)) for a, b in pairs]).first()
        reached = np.array([float(x) for x in sums[:count]])
        if np.abs(reached - targets).max() >= size * total:
            damp /= 2
            continue
        steps, now, damp = tried, reached, min(1.0, damp * 2)
        for (a, b), x in zip(pairs, sums[count:], strict=True):
            gram[a, b] = gram[b, a] = float(x)
    return Mix(domains, steps, targets.tolist(), now.tolist())


def mix_report(docs: DataFrame, labels: DataFrame, weights: dict[str, float], domain_col: str = "domain", id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """doc_id, tokens, domain (likeliest), posterior (by domain name), rate, copies of each row."""
    domains = fit_domains(docs, labels, domain_col, id_col, text_col)
    table = _posterior_table(docs, domains, id_col, text_col)
    mix = fit_mix(table, domains, weights)
    names = domains.names
    rate = F.round(_rate_column(mix.steps, len(names)), 9)
    best = F.array_max(F.array(*[F.struct(F.col(f"p{g}").alias("p"), F.lit(-g).alias("g")) for g in range(len(names))]))["g"]
    return table.select("doc_id", "tokens", F.get(F.array(*[F.lit(n) for n in names]), -best).alias("domain"),
                        *[F.col(f"p{g}").alias(f"posterior_{n}") for g, n in enumerate(names)], rate.alias("rate"), "chance").withColumn(
        "copies", F.floor(F.col("rate") + F.col("chance")).cast("int")).drop("chance")


def mixed(docs: DataFrame, labels: DataFrame, weights: dict[str, float], domain_col: str = "domain", id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, each as often as its rate asks for: the whole part, and one more by a draw that hashes id and text
    (``mix_report`` shows the same number). The draw goes along as one column behind the caller's, by place, not by name."""
    domains = fit_domains(docs, labels, domain_col, id_col, text_col)
    mix = fit_mix(_posterior_table(docs, domains, id_col, text_col), domains, weights)
    texts = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = TermIndex(domains.words)
        for batch in (part for whole in batches for part in sliced(whole, texts)):
            _, p = domains.posteriors(batch.column(texts).cast(pa.binary()).to_pylist(), index)
            chance = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            copies = np.floor(np.round(mix.rate(p), 9) + chance).astype(np.int64)
            rows = pa.RecordBatch.from_arrays(batch.columns[:-1], schema=pa.schema(list(batch.schema)[:-1]))
            yield rows.take(pa.array(np.repeat(np.arange(batch.num_rows), copies)))

    return docs.select("*", _chance(id_col, text_col).alias(free_name(docs.columns, "chance"))).mapInArrow(run, docs.schema)
