"""Joins against brute force."""

import random

import numpy as np
import pytest

from shoplens.llm import ngram_join, vectors
from shoplens.llm.common import connected_components
from tests.conftest import SF_SMALL

from .conftest import edge_pairs, make_docs


def words_of(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").translate(
        {c: " " for c in range(9, 14)}).split(" ")


def shingles(text, k):
    w = [x for x in words_of(text) if x]
    return set() if not w else {tuple(w)} if len(w) < k else {tuple(w[n:n + k]) for n in range(len(w) - k + 1)}


def brute(pairs, k, percent):
    sets = [shingles(t, k) for _, t in pairs]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    least = {}
    for n, (i, _) in enumerate(pairs):
        if i is not None:
            least[find(n)] = min(least.get(find(n), i), i)
    return [(i, len(sets[n]), least.get(find(n)) if sets[n] else i) for n, (i, _) in enumerate(pairs)], [find(n) for n in range(len(pairs))], sets


def near_copies(seed=3):
    """Groups of near copies of several sizes around the threshold, and texts that share a long passage only."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    out, n = [], 100
    passage = [word() for _ in range(120)]
    for _ in range(6):
        base = [word() for _ in range(rng.choice([8, 40, 200]))]
        for _ in range(25):
            w = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 5])):
                w[rng.randrange(len(w))] = word()
            out.append((n, " ".join(w)))
            n += 1
    for _ in range(40):
        out.append((n, " ".join(passage + [word() for _ in range(rng.choice([3, 8, 20, 60]))])))
        n += 1
    return out


@pytest.mark.parametrize("case,k,percent", [("sf", 3, 90), ("edge", 3, 90), ("copies", 3, 90), ("copies", 5, 80)])
def test_components(spark, docs, rows, case, k, percent):
    pairs = {"sf": rows, "edge": edge_pairs(), "copies": near_copies()}[case]
    table = docs if case == "sf" else make_docs(spark, pairs)
    got = ngram_join.ngram_components(table, k, percent).collect()
    want, _, _ = brute(pairs, k, percent)
    order = lambda r: tuple("~" if x is None else str(x) for x in r)
    assert sorted(map(order, want)) == sorted(order((r.doc_id, r.n_shingles, r.component_id)) for r in got)


@pytest.mark.parametrize("case", ["edge", "copies"])
def test_one_of_each_component_stays(spark, case):
    pairs = edge_pairs() if case == "edge" else near_copies(9)
    want, roots, sets = brute(pairs, 5, 80)
    kept = ngram_join.deduplicate(make_docs(spark, pairs)).collect()
    assert kept[0].__fields__ == ["doc_id", "text", "lang", "source", "n_chars"]
    count = {}
    for r in kept:
        s = shingles(r.text, 5)
        if s:
            n = next(n for n, p in enumerate(pairs) if p[1] == r.text and p[0] == r.doc_id)
            count[roots[n]] = count.get(roots[n], 0) + 1
            assert r.doc_id == want[n][2]
    assert count == {r: 1 for r, s in zip(roots, sets, strict=True) if s}
    empties = sorted(str(i) for (i, t), s in zip(pairs, sets, strict=True) if not s)
    assert sorted(str(r.doc_id) for r in kept if not shingles(r.text, 5)) == empties


def test_hot_tokens_are_counted_without_a_window(spark):
    held = [(c, 3, t) for c in range(300) for t in (7, 1000 + c, 2000 + c // 2)]
    shared = ngram_join._shared(spark.createDataFrame(held, "cid long, n int, token long"))
    assert sorted((r.cid, r.token, r.df) for r in shared.collect()) == sorted((c, t, 300 if t == 7 else 2) for c, _, t in held if not 1000 <= t < 2000)
    groups = [(g, 9, 300 - g, 0, 7) for g in range(300)] + [(300, 9, 0, 0, 8)]
    least = ngram_join._with_least(spark.createDataFrame(groups, "gid long, n int, own int, pos int, token long"))
    assert {tuple(r.least) for r in least.where("token = 7").collect()} == {(1, 299, 9)}
    for df in (shared, least):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and "SortMergeJoin" in plan


def test_long_chain_and_star_components(spark):
    edges = [(n, n + 1) for n in range(0, 120)] + [(1000, 1000 + n) for n in range(1, 200)] + [(5000, 5001), (5001, 5000), (7, 7)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    want = {n: 0 for n in range(121)} | {1000 + n: 1000 for n in range(200)} | {5000: 5000, 5001: 5000}
    assert got == want


def brute_vectors(rows, threshold=0.93):
    unit = []
    for _, v, k in rows:
        ok = k is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        x = np.array(v, float) if ok else None
        x = x / np.abs(x).max() if ok else None
        unit.append(x / np.linalg.norm(x) if ok else None)
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if unit[a] is not None and unit[b] is not None and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold:
                links[a] += 1
                links[b] += 1
                x, y = sorted((find(a), find(b)))
                root[y] = x
    least = {}
    for n, r in enumerate(rows):
        least[find(n)] = min(least.get(find(n), r[0]), r[0])
    return [(r[0], links[n], least[find(n)], r[0] == least[find(n)]) for n, r in enumerate(rows)]


SCHEMA = "vec_id long, embedding array<double>, label int"


def test_vectors_with_groups_and_odd_rows(spark):
    rng = np.random.default_rng(4)
    rows, n = [], 0
    for label in (0, 1):
        for _ in range(12):
            base = rng.standard_normal(24)
            for _ in range(rng.integers(1, 30)):
                rows.append((n, (base + rng.standard_normal(24) * rng.choice([0.05, 0.2, 0.3, 0.4])).tolist(), label))
                n += 1
    rows += [(900, rows[0][1], 0), (901, rows[0][1], 1), (902, rows[0][1], None), (903, None, 0), (904, [0.0] * 24, 0), (905, [float("nan")] * 24, 0),
             (906, [None] + [1.0] * 23, 0), (907, [], 0), (908, [1.0, 2.0], 0), (909, [2.0, 4.0], 0), (910, [1e200] * 24, 1), (911, [2e200] * 24, 1)]
    got = sorted(tuple(r) for r in vectors.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect())
    want = sorted(brute_vectors(rows))
    missed = sum(abs(a[1] - b[1]) for a, b in zip(got, want, strict=True))
    assert missed <= 0.01 * sum(w[1] for w in want), "recall below 0.99"
    assert all(a[1] <= b[1] for a, b in zip(got, want, strict=True))
    assert [a[2:] for a in got if a[0] >= 900] == [b[2:] for b in want if b[0] >= 900]


def test_vectors_on_the_given_table(spark, monkeypatch):
    monkeypatch.setattr(vectors, "PART", 20)  # many parts in a strip
    table = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding), r.label) for r in table.collect()]
    rows += [(10_000 + n, (np.array(rows[n][1]) * 1.5 + 1e-3).tolist(), rows[n][2]) for n in range(0, 200, 2)]
    got = vectors.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(tuple(r) for r in got) == sorted(brute_vectors(rows))


def test_hooks_of_later_links_keep_earlier_ones():
    batches = [[(0, 303), (1, 305), (2, 301), (2, 302), (3, 300), (3, 304)], [(300, 301), (302, 303), (304, 305)]]
    root = np.arange(306)
    for links in batches:
        root = vectors._hooked(root, *np.array(links).T)
    assert {n for n in range(306) if root[n] != n or n == 0} == {0, 1, 2, 3, 300, 301, 302, 303, 304, 305}
    assert set(root[[n for pair in sum(batches, []) for n in pair]]) == {0}


def test_long_shuffled_chain_in_one_part(spark):
    rng = np.random.default_rng(0)
    first = vectors.directions(64)[:, 0]
    chain = []
    for _ in range(640):  # steps across the first direction: all vectors lie in one strip
        step = rng.standard_normal(64)
        step -= step @ first * first
        if chain:
            step -= step @ chain[-1] * chain[-1]
        step /= np.linalg.norm(step)
        chain.append(np.cos(0.28) * chain[-1] + np.sin(0.28) * step if chain else step)
    rows = [(n, (chain[c] + 0.1 * first).tolist(), 0) for n, c in enumerate(rng.permutation(640))]
    got = sorted(tuple(r) for r in vectors.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == sorted(brute_vectors(rows)) and {g[2] for g in got} == {0}


def test_empty_tables(spark):
    assert ngram_join.ngram_components(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    assert vectors.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


CLASHES = ["_w", "_hit", "_at", "_word", "_bits", "text_", "digest_", "component_", "least_", "whole", "at", "row", "words", "id", "component", "least", "chance",
           "digest", "tokens", "bits", "doc", "n"]


def test_every_internal_name_may_be_a_callers_column(spark):
    """The bit table and the deduplication keep a caller's columns as they are, whatever their names."""
    from pyspark.sql import functions as F

    from shoplens.llm import mixing, ngram_join, quality
    from shoplens.llm.idfilter import maybe_in

    base = " ".join(f"word{n}" for n in range(40))
    pairs = [(1, base), (2, base + " more"), (3, "quite another text with some words of its own"), (4, None), (5, base), (None, base), (6, "")]
    docs = make_docs(spark, pairs)
    extra = docs.select("*", *[F.concat(F.lit(f"{n}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(c) for n, c in enumerate(CLASHES)])

    def whole(df):
        return sorted(map(repr, (tuple(r) for r in df.collect())))

    kept = ngram_join.deduplicate(extra, k=5, percent=80)
    assert kept.columns == extra.columns
    wanted = extra.where("doc_id IN (1, 3, 4, 6)")
    assert whole(kept) == whole(wanted)
    held, other = maybe_in(extra, "doc_id", docs.select("doc_id").where("doc_id < 3"), split=True)
    assert whole(held.unionByName(other)) == whole(extra) and {1, 2} <= {r.doc_id for r in held.collect()}
    assert whole(quality.keep_good(extra, quality.Additive(1.0))) == whole(extra)
    model = mixing.Domains(["a"], {}, np.zeros((1, 1)))
    mixed = mixing.mixed(extra, docs.select("doc_id", F.lit("a").alias("domain")), {})
    assert mixed.columns == extra.columns and whole(mixed) == whole(extra) and model.names == ["a"]


def test_bitmaps_never_rule_out_a_pair():
    from shoplens.llm.sets import PARITY_WORDS, parity

    rng = np.random.default_rng(3)
    for _ in range(200):
        a = np.unique(rng.integers(-(1 << 62), 1 << 62, rng.integers(0, 400)))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.9], rng.integers(-(1 << 62), 1 << 62, rng.integers(0, 60))]))
        apart = int(np.bitwise_count((parity(a) ^ parity(b)).view(np.uint64)).sum())
        assert len(parity(a)) == PARITY_WORDS and apart <= len(np.setxor1d(a, b))


def test_bit_table_grows_with_its_ids(spark, monkeypatch):
    from shoplens.llm import idfilter

    ids, rows = spark.range(0, 30_000, 3), spark.range(0, 30_000)
    sized = idfilter.maybe_in(rows, "id", ids).count()
    assert 10_000 <= sized < 13_000  # about 6 % of the others
    monkeypatch.setattr(idfilter, "MOST", 1 << 10)
    monkeypatch.setattr(idfilter, "LEAST", 1 << 10)
    full = idfilter.maybe_in(rows, "id", ids)
    assert full.count() == 30_000 and full.join(ids, "id", "left_semi").count() == 10_000
