"""Classifiers, mixing and sampled segmentations: held-out accuracy, brute force, exact round trips, odd rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from shoplens.llm import catalog, language, mixing, quality, segment
from tests.conftest import SF_CHECK

from .conftest import edge_pairs, make_docs


@pytest.fixture(scope="module")
def big(spark):
    return spark.read.parquet(f"{SF_CHECK}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF_CHECK}/labels.parquet")


def is_held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 1


@pytest.fixture(scope="module")
def quality_model(big, labels):
    return quality.fit_on(big, labels)


def test_quality_held_out_accuracy(spark, big, labels):
    got = {r.doc_id: r for r in E.queries()["op2_quality"](spark, SF_CHECK).collect()}
    assert len(got) == big.count()
    assert all(r.held_out == is_held_out(i) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for i, r in got.items())
    held = [(r.quality, got[r.doc_id].predicted) for r in labels.collect() if is_held_out(r.doc_id)]
    assert sum(a == b for a, b in held) / len(held) > 0.95
    assert sum(a == b == 0 for a, b in held) / sum(a == 0 for a, _ in held) > 0.85


def test_quality_never_reads_held_out_labels(big, labels, quality_model):
    flipped = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = quality.fit_on(big, flipped)
    assert again.intercept == quality_model.intercept
    assert all((a == b).all() for a, b in zip(again.tables, quality_model.tables, strict=True))


def test_quality_odd_rows(spark, quality_model):
    table = make_docs(spark, edge_pairs()).withColumn("score", F.lit("clash")).withColumn("held_out", F.lit(1))
    got = quality.quality_scores(table, quality_model).collect()
    assert sorted(map(str, (r.doc_id for r in got))) == sorted(str(i) for i, _ in edge_pairs())
    assert all(0 <= r.score <= 1 for r in got) and not any(r.held_out for r in got if r.doc_id is None)
    kept = quality.keep_good(table, quality_model)
    assert kept.columns == table.columns and kept.count() == sum(r.predicted for r in got)
    empty = spark.createDataFrame([], "doc_id long, quality int")
    flat = quality.fit_on(make_docs(spark, [(1, "x")]), empty)
    assert [r.score for r in quality.quality_scores(make_docs(spark, [(1, "x")]), flat).collect()] == [0.5]
    assert quality.quality_scores(spark.createDataFrame([], "doc_id long, text string"), quality_model).collect() == []


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.uniform(-1, 1, (4000, 3))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    model = quality.fit(x[:3000], y[:3000])
    assert ((model.scores(x[3000:]) >= 0.5) == (y[3000:] > 0)).mean() > 0.9


def longest_match_phrases(text, sample):
    """Greedy parse of a whole text into longest matches inside the sample; a letter that is not in it is a phrase."""
    n = at = 0
    while at < len(text):
        end = at + 1
        while end <= len(text) and text[at:end] in sample:
            end += 1
        at = max(at + 1, end - 1)
        n += 1
    return n


@pytest.mark.parametrize(("block", "dense"), [(512, 46), (5, 46), (1, 2), (37, 1)])
def test_phrases_equal_a_plain_longest_match_parse(monkeypatch, block, dense):
    """Whatever the blocks and however many letters have a column, the parse is that of the whole text."""
    monkeypatch.setattr(language, "BLOCK", block)
    rng = np.random.default_rng(2)
    samples = {"a": ["".join(rng.choice(list("abc "), 900))], "b": ["".join(rng.choice(list("bcd "), 900))], "c": ["ab" * 300 + "d" + "ab" * 100]}
    model = language.learn(samples, 800, dense)
    texts = ["".join(rng.choice(list("abcde "), n)) for n in (1, 3, 200, 1500)] + ["ab" * 700, "e" * 60, "", "ab" * 90 + "e" + "ab" * 300, samples["a"][0][:700]]
    coded = [language.spelled(t, model.classes) for t in texts]
    got = language.phrases(coded, model)
    text = lambda x: "".join(map(chr, x.tolist()))
    for k, name in enumerate(model.names):
        sample = text(language.spelled(samples[name][0][:800], model.classes))
        for n, c in enumerate(coded):
            assert got[n, k] == longest_match_phrases(text(c), sample)


def test_every_script_of_the_samples_counts(spark):
    """Five scripts with far more letters than there are columns: each text is told by its own letters; long texts are learned
    from any place, so a foreign beginning does not stand for a language."""
    rng = np.random.default_rng(4)
    scripts = {"el": range(0x3B1, 0x3CA), "en": range(97, 123), "he": range(0x5D0, 0x5EB), "ru": range(0x430, 0x450), "zh": range(0x4E00, 0x4E00 + 700)}
    letters = {k: list(map(chr, v)) for k, v in scripts.items()}
    words = {k: ["".join(rng.choice(v, rng.integers(1, 7))) for _ in range(300)] for k, v in letters.items()}
    rows = [(n, " ".join(rng.choice(words[k], 120)), k) for n, k in enumerate(sorted(words) * 30)]
    rows += [(1000 + n, " ".join(rng.choice(words["en"], 700)) + " " + " ".join(rng.choice(words["ru"], 60_000)), "ru") for n in range(6)]
    docs = make_docs(spark, [(i, t) for i, t, _ in rows]).drop("lang").join(spark.createDataFrame([(i, k) for i, _, k in rows], "doc_id long, lang string"), "doc_id")
    model = language.fit_on(docs)
    assert model.classes.max() > 500 and model.steps.shape[1] == language.DENSE + 2 and len(model.keys)
    fresh = [(n, " ".join(rng.choice(words[k], 40)), k) for n, k in enumerate(sorted(words) * 20)]
    found = {r.doc_id: r.lang_pred for r in language.predict_languages(make_docs(spark, [(i, t) for i, t, _ in fresh]), model).collect()}
    assert all(found[i] == k for i, _, k in fresh)


def test_language_held_out_accuracy(spark, big):
    got = {r.doc_id: r for r in E.queries()["op5_language"](spark, SF_CHECK).collect()}
    assert len(got) == big.count()
    known = [(r.lang, got[r.doc_id]) for r in big.collect() if is_held_out(r.doc_id)]
    assert sum(a == b.lang_pred for a, b in known) / len(known) > 0.98
    assert all(b.held_out and 0 <= b.score <= 1 for _, b in known)


def test_language_odd_rows(spark, big):
    model = language.fit_on(big)
    table = make_docs(spark, edge_pairs() + [(20, "123 !!! 456")]).withColumn("score", F.lit("clash"))
    got = language.predict_languages(table, model).collect()
    assert len(got) == len(edge_pairs()) + 1
    by = {r.doc_id: r for r in got}
    assert by[2].lang_pred == by[3].lang_pred == by[7].lang_pred == by[20].lang_pred == "und" and by[20].score == 0
    assert by[9].lang_pred in model.names
    none = language.fit_on(make_docs(spark, [(1, "x")]).withColumn("lang", F.lit(None).cast("string")))
    assert [r.lang_pred for r in language.predict_languages(make_docs(spark, [(1, "x")]), none).collect()] == ["und"]


def test_mixing_reaches_its_targets(spark, big, labels):
    domains = mixing.fit_domains(big, catalog.domain_labels(spark, SF_CHECK))
    table = mixing._posterior_table(big, domains, "doc_id", "text")
    weights = {"good-clean": 0.85, "good-toxic": 0.03, "poor-clean": 0.11, "poor-toxic": 0.01}
    mix = mixing.fit_mix(table, domains, weights)
    rows = table.collect()
    p = np.array([[r[f"p{g}"] for g in range(4)] for r in rows])
    tokens = np.array([r.tokens for r in rows])
    rate = mix.rate(p)
    assert (rate >= 0).all()
    totals = (rate * tokens) @ p
    assert np.allclose(totals, mix.reached, rtol=1e-6)
    want = np.array([weights[n] for n in domains.names]) * tokens.sum()
    assert np.abs(totals - want).max() < 1e-4 * tokens.sum()
    report = mixing.mix_report(big, catalog.domain_labels(spark, SF_CHECK), weights).collect()
    assert np.allclose(sorted(r.rate for r in report), sorted(rate), atol=1e-6)
    assert all(int(r.rate) <= r.copies <= int(r.rate) + 1 for r in report)


def test_mixing_classifier_held_out(spark, big):
    truth = {r.doc_id: r.domain for r in catalog.domain_labels(spark, SF_CHECK).collect()}
    report = {r.doc_id: r.domain for r in E.queries()["op9_mixing"](spark, SF_CHECK).collect()}
    held = [(d, report[i]) for i, d in truth.items() if is_held_out(i)]
    assert sum(a == b for a, b in held) / len(held) > 0.85


def test_mixing_odd_rows(spark):
    pairs = edge_pairs() + [(n, "good words here" if n % 2 else "bad stuff there") for n in range(100, 160)]
    table = make_docs(spark, pairs).withColumn("rate", F.lit("clash"))
    marks = spark.createDataFrame([(n, "good" if n % 2 else "bad") for n in range(100, 160)] + [(1, None)], "doc_id long, domain string")
    got = mixing.mix_report(table, marks, {"bad": 0.1}).collect()
    assert len(got) == len(pairs) and all(r.rate >= 0 for r in got)
    out = mixing.mixed(table, marks, {"bad": 0.1})
    assert out.columns == table.columns
    none = mixing.mixed(table, spark.createDataFrame([], "doc_id long, domain string"), {})
    assert none.count() == len(pairs)
    assert mixing.mix_report(spark.createDataFrame([], "doc_id long, text string"), marks, {}).collect() == []


@pytest.fixture(scope="module")
def lattice():
    with open(segment.default_model(), "rb") as f:
        return segment.Lattice(segment.Vocabulary(f.read(), 0.3))


def every_path(v, pieces, text):
    """All segmentations of a text with their log-probabilities."""
    done = [((), 0.0)]
    for unit in v.split(text):
        def paths(rest):
            if not rest:
                return [((), 0.0)]
            out = []
            for n in range(1, min(v.longest, len(rest)) + 1):
                if rest[:n] in pieces:
                    ids, w = (pieces[rest[:n]],), v.weight[pieces[rest[:n]]]
                elif n == 1:
                    ids = tuple(int(v.byte_id[b]) for b in rest[0].encode())
                    w = len(ids) * v.byte_weight
                else:
                    continue
                out += [(ids + a, w + x) for a, x in paths(rest[n:])]
            return out
        done = [(a + b, x + y) for a, x in done for b, y in paths(unit)]
    z = np.logaddexp.reduce([x for _, x in done])
    return {a: x - z for a, x in done}


@pytest.fixture(scope="module")
def pieces():
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=segment.default_model())
    return {sp.id_to_piece(n): n for n in range(sp.get_piece_size()) if not (sp.is_byte(n) or sp.is_control(n) or sp.is_unknown(n))}


def test_samples_follow_the_distribution_without_replacement(lattice, pieces):
    text, n, k = "the an ☃", 6000, 3
    paths = every_path(lattice.v, pieces, text)
    got = segment.sample_batch(lattice, [text] * n, segment._stream(np.arange(n).astype(np.uint64), 3), k)
    first, second, weighted = {}, {}, {}
    for rows in got:
        keys = [tuple(r[0].tolist()) for r in rows]
        assert len(set(keys)) == k and [r[2] for r in rows] == sorted((r[2] for r in rows), reverse=True)
        for key, r in zip(keys, rows, strict=True):
            assert abs(paths[key] - r[1]) < 1e-9
            weighted[key] = weighted.get(key, 0) + 1 / r[3] / n * np.exp(paths[key])
        first[keys[0]] = first.get(keys[0], 0) + 1 / n
        second[keys[1]] = second.get(keys[1], 0) + 1 / n
    for key, x in sorted(paths.items(), key=lambda t: -t[1])[:6]:
        p = np.exp(x)
        q = sum(np.exp(y) * p / (1 - np.exp(y)) for other, y in paths.items() if other != key)
        assert abs(first.get(key, 0) - p) < 4 * np.sqrt(p / n) and abs(second.get(key, 0) - q) < 4 * np.sqrt(q / n)
    # inclusion scores make the weighted samples an unbiased sum over all paths
    assert abs(sum(weighted.values()) - 1) < 0.03


def test_few_paths_and_later_siblings(lattice, pieces, monkeypatch):
    assert [r[3] for r in segment.sample_batch(lattice, [""], np.array([5], np.uint64), 3)[0]] == [1.0]
    text = "a b"
    paths = every_path(lattice.v, pieces, text)
    rows = segment.sample_batch(lattice, [text], np.array([9], np.uint64), len(paths) + 3)[0]
    assert {tuple(r[0].tolist()) for r in rows} == set(paths) and all(r[3] == 1.0 for r in rows)
    # with a head of nothing, every sibling sits behind the one later node, which must be opened
    monkeypatch.setattr(segment, "HEAD", 0.0)
    text = "the an"
    paths = every_path(lattice.v, pieces, text)
    n = 4000
    got = segment.sample_batch(lattice, [text] * n, segment._stream(np.arange(n).astype(np.uint64), 4), 2)
    second = {}
    for rows in got:
        assert len({tuple(r[0].tolist()) for r in rows}) == 2
        key = tuple(rows[1][0].tolist())
        second[key] = second.get(key, 0) + 1 / n
    for key, x in sorted(paths.items(), key=lambda t: -t[1])[:4]:
        q = sum(np.exp(y) * np.exp(x) / (1 - np.exp(y)) for other, y in paths.items() if other != key)
        assert abs(second.get(key, 0) - q) < 4 * np.sqrt(q / n)


def test_round_trip_and_independence_of_batches(spark, docs, rows, monkeypatch):
    pairs = rows[:60] + edge_pairs()
    table = make_docs(spark, pairs).withColumn("ids", F.lit("clash"))
    one = segment.sample_segmentations(table.coalesce(1), k=2)
    many = segment.sample_segmentations(table.repartition(7), k=2)
    order = lambda r: (str(r.doc_id), r.sample, r.n_pieces, r.log_prob, str(r.ids), r.perturbed, r.inclusion)
    a, b = sorted(map(order, one.collect())), sorted(map(order, many.collect()))
    assert a == b
    assert all(r.round_trip for r in one.collect())
    decoded = segment.decode_ids(one.where("sample = 1 and doc_id < 60 and doc_id > 20")).collect()
    texts = dict(rows[:60])
    assert decoded and all(r.decoded == texts[r.doc_id] for r in decoded)
    assert segment.sample_segmentations(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_small_tables_of_the_lattice_change_nothing(lattice):
    texts = ["the quick brown fox\njumps  over", "ünïcödé ☃ 日本", "x" * 200]
    seeds = np.array([1, 2, 3], np.uint64)
    want = segment.sample_batch(lattice, texts, seeds, 2)
    tight = segment.Lattice(lattice.v)
    tight._new(40, 200)
    for n in range(3):
        got = segment.sample_batch(tight, texts[n:n + 1], seeds[n:n + 1], 2)[0]
        assert [(r[0].tolist(), r[1], r[2]) for r in got] == [(r[0].tolist(), r[1], r[2]) for r in want[n]]


def test_new_units_are_added_in_small_parts(lattice, monkeypatch):
    texts = ["the quick brown fox\njumps  over", "ünïcödé ☃ 日本 the quick", "x" * 200]
    seeds = np.array([1, 2, 3], np.uint64)
    want = segment.sample_batch(segment.Lattice(lattice.v), texts, seeds, 2)
    parts, add = [], segment.Lattice._add
    monkeypatch.setattr(segment, "ADD_CHARS", 10)
    monkeypatch.setattr(segment.Lattice, "_add", lambda self, units: (parts.append(units), add(self, units))[1])
    got = segment.sample_batch(segment.Lattice(lattice.v), texts, seeds, 2)
    assert len(parts) > 3 and all(sum(map(len, p[:-1])) < 10 for p in parts)
    assert len({u for p in parts for u in p}) == sum(map(len, parts))
    for a, b in zip(got, want, strict=True):
        assert [(r[0].tolist(), r[3]) for r in a] == [(r[0].tolist(), r[3]) for r in b]
        assert np.allclose([r[1:3] for r in a], [r[1:3] for r in b], rtol=0, atol=1e-9)


def test_memory_settings_change_nothing(spark, rows):
    table = make_docs(spark, rows[:80])
    fields = ("doc_id", "sample", "ids", "n_pieces", "log_prob", "perturbed", "inclusion", "round_trip")
    key = lambda r: str([getattr(r, f) if f not in ("log_prob", "perturbed", "inclusion") else round(getattr(r, f), 9) for f in fields])
    want = sorted(map(key, segment.sample_segmentations(table, k=2).collect()))
    assert sorted(map(key, segment.sample_segmentations(table, k=2, nodes=2_000, batch_bytes=3_000).collect())) == want


def test_units_of_many_texts_are_those_of_each(lattice):
    """One pass over the bytes of a batch cuts it where the pattern cuts each text, and names a repeated unit once."""
    texts = ["a  b\nc", "", " ", "\n\n x\t▁y ", "a  b", "é 日本 \U0001f600\x00 \ud800z", "\r", "a "]
    units, place, counts = lattice.v.split_all(texts)
    assert len(set(units)) == len(units)
    spelled = [units[n].decode("utf-8", "surrogatepass").replace(" ", segment.SPACE) for n in place]
    ends = np.cumsum(counts)
    assert [spelled[e - n:e] for e, n in zip(ends, counts, strict=True)] == [lattice.v.split(t) for t in texts]
    assert lattice.v.split_all(["", ""])[2].tolist() == [0, 0]
