"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built over a sample of its labelled text. It yields, from any place of a text,
the longest match that occurs anywhere in the sample: the text is parsed from left to right into such longest
matches, and the language that needs the fewest phrases per character explains it best.

Every letter of the samples has a class. The automata of all languages are stacked; transitions of the ``DENSE`` most
frequent letters stand in a table (state x letter class), those of all others, such as the letters of a second script, in
sorted keys. Both are sized by parameters and the number of languages (about 11 MB each), not by the corpus.

A batch of texts is parsed in lockstep: whole texts are cut into blocks, and one gather advances all blocks under all
languages, each as if a phrase began with it. Then every block is entered once more with the state that its predecessor
really ends in, until the two parses meet (equal states have equal futures, mostly a few phrases on); the blocks behind one
that did not meet by its end are entered again. The result is the parse of the whole text, whatever ``BLOCK`` is.

Learning uses only rows with a language whose id has crc32 mod 3 other than 1; per language a hash-chosen, bounded
number of characters is read (``SAMPLE_CHARS``), from hash-chosen places of the texts. Null texts and texts without a letter get ``und`` and score 0. Ties go
to the language that comes first by name. Repeated rows are predicted alike; null ids are never held out nor learned
from; extra columns are ignored; an empty table gives an empty result, and without any labelled text all is ``und``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sliced
from .quality import held_out

SAMPLE_CHARS = 30_000  # characters of labelled text in each language's automaton
DENSE = 46  # most frequent letters with a column of the transition table; the others are looked up in sorted keys
UNKNOWN, GAP = 0, 1  # classes of a letter that no sample holds, and of a run of anything but letters
BLOCK = 512
BLOCK_BYTES = 1 << 20  # texts that are parsed in lockstep (or a single longer one)
FETCHED = 4  # times as many characters are fetched at most, to fill the sample from several texts


class SuffixAutomaton:
    """Smallest automaton of all substrings of a sequence of letter classes."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.last = [-1], [0], 0

    def extend(self, letter: int) -> None:
        cur = len(self.next)
        self.next.append({})
        self.length.append(self.length[self.last] + 1)
        self.link.append(0)
        p = self.last
        while p >= 0 and letter not in self.next[p]:
            self.next[p][letter] = cur
            p = self.link[p]
        if p >= 0:
            q = self.next[p][letter]
            if self.length[p] + 1 == self.length[q]:
                self.link[cur] = q
            else:
                copy = len(self.next)
                self.next.append(dict(self.next[q]))
                self.length.append(self.length[p] + 1)
                self.link.append(self.link[q])
                while p >= 0 and self.next[p].get(letter) == q:
                    self.next[p][letter] = copy
                    p = self.link[p]
                self.link[q] = self.link[cur] = copy
        self.last = cur

    def transitions(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(state, letter, next state) of every transition."""
        rows = [(state, letter, to) for state, steps in enumerate(self.next) for letter, to in steps.items()]
        return tuple(np.array(rows, np.int64).reshape(-1, 3).T)


@dataclass
class Languages:
    names: list
    classes: np.ndarray  # code point -> letter class
    steps: np.ndarray  # stacked transitions of the dense classes, global states; -1 for none
    starts: np.ndarray  # start state of each language
    keys: np.ndarray  # state * letters + class of the other transitions, ascending
    to: np.ndarray  # where they lead

    def follow(self, state: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """Next states (languages x lanes) under the lanes' letters, -1 for none."""
        width = self.steps.shape[1]
        out = self.steps.ravel()[state * width + np.minimum(letter, width - 1)].astype(np.int64)
        rare = np.flatnonzero(letter >= width)
        if len(rare):
            out[:, rare] = -1
            if len(self.keys):
                key = state[:, rare] * (int(self.classes.max()) + 1) + letter[rare]
                at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                out[:, rare] = np.where(self.keys[at] == key, self.to[at], -1)
        return out


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)


def spelled(text: str, classes: np.ndarray) -> np.ndarray:
    """Letter classes of a whole text; marks, digits and white space between letters count as one gap."""
    at = classes[codes(text)]
    return at[np.r_[True, (at[1:] != GAP) | (at[:-1] != GAP)]] if len(at) else at


def learn(samples: dict[str, list[str]], chars: int = SAMPLE_CHARS, dense: int = DENSE) -> Languages:
    """One automaton per language from its texts; every letter of the samples has a class, the most frequent ones first."""
    names = sorted(samples)
    joined = {n: " ".join(samples[n])[:chars] for n in names}
    seen = Counter()
    for n in names:
        seen.update(filter(str.isalpha, joined[n].lower()))
    classes = np.array([UNKNOWN if chr(c).isalpha() else GAP for c in range(0x110000)], np.int32)
    for k, (c, _) in enumerate(sorted(seen.items(), key=lambda x: (-x[1], x[0])), GAP + 1):
        classes[ord(c)] = k
    letters, width = int(classes.max()) + 1, dense + 2
    tables, starts, keys, to, base = [], [], [], [], 0
    for n in names:
        made = SuffixAutomaton()
        for k in spelled(joined[n], classes).tolist():
            made.extend(k)
        state, letter, target = made.transitions()
        t = np.full((len(made.next), width), -1, np.int32)
        often = letter < width
        t[state[often], letter[often]] = target[often] + base
        keys.append((state[~often] + base) * letters + letter[~often])
        to.append(target[~often] + base)
        tables.append(t)
        starts.append(base)
        base += len(t)
    steps = np.concatenate(tables) if tables else np.zeros((0, width), np.int32)
    keys, to = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (keys, to))
    order = np.argsort(keys)
    return Languages(names, classes, steps, np.array(starts, np.int32), keys[order], to[order])


def _step(model: Languages, at: np.ndarray, letter: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """States after a letter, and where it opened a phrase: the longest match ended before it, or nothing was open. A letter
    that begins no match is a phrase by itself."""
    to = model.follow(at, letter)
    broken = to < 0
    opened = broken | (at == start)
    if broken.any():
        again = model.follow(start, letter)
        to = np.where(broken, np.where(again < 0, start, again), to)
    return to, opened


def phrases(texts: list[np.ndarray], model: Languages) -> np.ndarray:
    """Number of phrases of each whole text (as letter classes) under each language."""
    total = np.zeros((len(texts), len(model.names)), np.int64)
    pieces = [(len(t) - a, n, a) for n, t in enumerate(texts) for a in range(0, len(t), BLOCK)]
    if not pieces:
        return total
    pieces.sort(key=lambda x: -min(x[0], BLOCK))
    owner = np.array([n for _, n, _ in pieces])
    lengths = np.array([min(left, BLOCK) for left, _, _ in pieces])
    grid = np.zeros((lengths[0], len(pieces)), np.int32)
    for k, (_, n, a) in enumerate(pieces):
        grid[:lengths[k], k] = texts[n][a:a + BLOCK]
    live = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), side="right")  # pieces still running at each step
    start = np.repeat(model.starts.astype(np.int64)[:, None], len(pieces), 1)
    state, count = start.copy(), np.zeros((len(model.names), len(pieces)), np.int64)
    for k in range(lengths[0]):
        m = live[k]
        state[:, :m], opened = _step(model, state[:, :m], grid[k, :m].astype(np.int64), start[:, :m])
        count[:, :m] += opened
    # enter every block with its predecessor's end, until the parse meets the one that was made
    place = {(n, a): k for k, (_, n, a) in enumerate(pieces)}
    before = np.array([place.get((n, a - BLOCK), -1) for _, n, a in pieces])
    after = np.full(len(pieces), -1)
    after[before[before >= 0]] = np.flatnonzero(before >= 0)
    found = state.copy()  # ends of the blocks as parsed from a fresh start: what a second parse is compared with
    added = np.zeros_like(count)
    todo = np.flatnonzero(before >= 0)
    while len(todo):
        entry = state[:, before[todo]]
        fresh, real = start[:, todo].copy(), entry.copy()
        more = np.zeros((len(model.names), len(todo)), np.int64)
        met = real == fresh
        lanes = np.flatnonzero(~met.all(0))
        k = 0
        while len(lanes):
            lanes = lanes[lengths[todo[lanes]] > k]
            if not len(lanes):
                break
            letter, first = grid[k, todo[lanes]].astype(np.int64), start[:, todo[lanes]]
            one, opened_one = _step(model, fresh[:, lanes], letter, first)
            two, opened_two = _step(model, real[:, lanes], letter, first)
            open_ = ~met[:, lanes]
            more[:, lanes] += open_ * (opened_two.astype(np.int64) - opened_one)
            fresh[:, lanes], real[:, lanes] = one, two
            met[:, lanes] |= one == two
            lanes = lanes[~met[:, lanes].all(0)]
            k += 1
        ends = np.where(met, found[:, todo], real)
        moved = (ends != state[:, todo]).any(0)
        state[:, todo], added[:, todo] = ends, more
        behind = after[todo[moved]]
        todo = behind[behind >= 0]
    np.add.at(total, owner, (count + added).T)
    return total


def predict(texts: list[str | None], model: Languages) -> tuple[list[str], np.ndarray]:
    """Language and score of each text; the score is the winner's share of the likelihood-like weights 2^-(phrases), per 10 phrases."""
    known = [t is not None and any(map(str.isalpha, t)) and bool(model.names) for t in texts]
    coded = [spelled(t, model.classes) if ok else np.zeros(0, np.int32) for t, ok in zip(texts, known, strict=True)]
    if not model.names:
        return ["und"] * len(texts), np.zeros(len(texts))
    total = phrases(coded, model)
    best = total.argmin(1)
    least = total.min(1)[:, None]
    score = 1 / np.exp2(-(total - least) / 10).sum(1)
    return [model.names[b] if ok else "und" for b, ok in zip(best, known, strict=True)], np.where(known, score, 0.0)


def fit_on(docs: DataFrame, chars: int = SAMPLE_CHARS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Languages:
    """Reads a hash-chosen share of each language's labelled texts, enough for ``chars`` characters of each."""
    usable = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).where(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & ~held_out())
    part = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(5)), F.lit(1_000_000))
    sizes = usable.groupBy("lang").agg(F.sum(F.least(F.length("text"), F.lit(chars // 10))).alias("chars"))
    shares = sizes.select("lang", F.least(F.lit(1.0), F.lit(FETCHED * chars) / F.greatest("chars", F.lit(1))).alias("share"))
    # one text gives a tenth of the sample at most, so that a few long ones do not stand for the language, from a place that a
    # hash of its id chooses
    place = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(6)), F.greatest(F.length("text") - chars // 10, F.lit(0)) + 1) + 1
    picked = usable.join(F.broadcast(shares), "lang").where(part < F.col("share") * 1_000_000).select(
        "lang", part.alias("part"), "doc_id", F.substring(F.col("text"), place.cast("int"), F.lit(chars // 10)).alias("text"))
    samples: dict[str, list[str]] = {}
    for r in sorted(picked.collect(), key=lambda r: (r["lang"], r["part"], r["doc_id"])):
        samples.setdefault(r["lang"], []).append(r["text"])
    return learn(samples, chars)


def predict_languages(docs: DataFrame, model: Languages, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score of each row."""
    shared = docs.sparkSession.sparkContext.broadcast((model.names, model.classes, model.steps, model.starts, model.keys, model.to))  # sized by the parameters

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Languages(*shared.value)
        for batch in batches:
            for part in sliced(batch, "text", BLOCK_BYTES):
                names, score = predict(part.column("text").to_pylist(), known)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(names, pa.string()), pa.array(score, pa.float64())],
                                                 names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
