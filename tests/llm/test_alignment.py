import hashlib
import json
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers

from shoplens.llm import alignment, catalog
from shoplens.llm.alignment import Csr, from_entries, row_products, tiling, transposed
from tests.conftest import SF_SMALL
from tests.llm.conftest import edge_pairs, make_docs

COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps")


def dense(x, width):
    out = np.zeros((x.rows, width), np.int64)
    for i in range(x.rows):
        for n in range(x.ptr[i], x.ptr[i + 1]):
            out[i, x.cols[n]] += 1 if x.values is None else x.values[n]
    return out


def test_row_products_equal_dense_products():
    rng = np.random.default_rng(1)
    for rows, inner, width, limit in ((1, 1, 1, 1), (5, 7, 3, 2), (40, 30, 50, 17), (60, 20, 9, 10_000)):
        x = from_entries(rng.integers(0, rows, 90), rng.integers(0, inner, 90), rows, inner)
        y = from_entries(rng.integers(0, inner, 70), rng.integers(0, width, 70), inner, width)
        got = np.zeros((rows, width), np.int64)
        for r, c, v in row_products(x, y, width, limit):
            got[r, c] += v
        assert (got == dense(x, inner) @ dense(y, width)).all()
        assert (dense(transposed(x, inner), rows) == dense(x, inner).T).all()
    empty = Csr(np.zeros(4, np.int64), np.zeros(0, np.int64))
    assert [len(r) for r, _, _ in row_products(empty, tiling(np.array([], np.int64)), 1)] == [0]


@pytest.fixture(scope="module")
def plain():
    """Token by token, with the libraries' own tables read anew."""
    first = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))

    def spell_a(n):
        return first.id_to_token(n)

    to_byte = {}
    for b in range(256):
        # a byte alone is one token, whose name shows the character that stands for it
        to_byte.setdefault(alignment_char(b), b)

    def of(text):
        spaced = (" " + (text or "")).encode()
        if not text:
            return None
        a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
        bytes_a = [bytes(to_byte[c] for c in spell_a(n)) for n in a]
        bytes_b = [bytes([int(p[3:5], 16)]) if second.is_byte(n) else p.replace("▁", " ").encode() for n, p in ((n, second.id_to_piece(n)) for n in b)]
        if b"".join(bytes_a) != spaced or b"".join(bytes_b) != spaced:
            return None
        groups, i, j, end_a, end_b, overlaps = [], 0, 0, 0, 0, 0
        ga, gb = [], []
        while i < len(a) or j < len(b):
            if end_a <= end_b:
                ga.append(a[i])
                end_a += len(bytes_a[i])
                i += 1
            else:
                gb.append(b[j])
                end_b += len(bytes_b[j])
                j += 1
            if end_a == end_b and ga and gb:
                groups.append((ga, gb))
                ga, gb = [], []
        # every byte where a token of either side begins opens one overlap more
        starts = {sum(map(len, bytes_a[:n])) for n in range(len(a))} if len(a) < 400 else set(np.cumsum([0, *map(len, bytes_a)])[:-1].tolist())
        starts |= set(np.cumsum([0, *map(len, bytes_b)])[:-1].tolist())
        overlaps = len(starts)
        return a, b, groups, overlaps

    return of


def alignment_char(b):
    shown = set(range(33, 127)) | set(range(161, 173)) | set(range(174, 256))
    return chr(b) if b in shown else chr(256 + sorted(set(range(256)) - shown).index(b))


def expected(plain, pairs):
    made = [(i, plain(t)) for i, t in pairs]
    docs_of, out = Counter(), []
    linked = [Counter((x, y) for ga, gb in m[2] for x in ga for y in gb) if m else Counter() for _, m in made]
    for links in linked:
        docs_of.update(links.keys())
    most = {}
    for (x, _), n in docs_of.items():
        most[x] = max(most.get(x, 0), n)
    for (i, m), links in zip(made, linked, strict=True):
        if m is None:
            out.append((i, 0, 0, 0, 0, 0, 0, "", 0))
            continue
        a, b, groups, overlaps = m
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        out.append((i, len(a), len(b), len(groups), sum(links.values()), sum(v for p, v in links.items() if docs_of[p] == most[p[0]]),
                    sum(v * docs_of[p] for p, v in links.items()), hashlib.sha256(text.encode()).hexdigest(), overlaps))
    return sorted(out, key=order)


def order(r):
    return (r[0] is None, r[0] or 0, r[1:])


def got(df):
    return sorted(((r.doc_id, *(r[c] for c in COLUMNS)) for r in df.collect()), key=order)


def test_query_equals_plain_version(spark, rows, plain):
    assert got(catalog.op11_token_alignment(spark, SF_SMALL)) == expected(plain, rows)


def odd_texts():
    rng = random.Random(8)
    marks = "abé ß日本😀▁ ́\t\n.,<0x41>𝄞한글ﬁ"
    out = edge_pairs() + [(30, "<|endoftext|> <s> </s> <unk>"), (31, "▁already marked"), (32, "naïve café ﬁne Ⅻ"), (33, "  two  spaces "), (34, "​﻿"),
                          (35, "<0x41>"), (36, "x" * 9_000), (38, " " * 12_000 + "a"), (39, "a" + "\n" * 12_000), (40, "tail  "), (41, " "), (42, "b "), (37, "日本語" * 3_000)]
    return out + [(100 + n, "".join(rng.choice(marks) for _ in range(rng.randint(1, 60)))) for n in range(60)]


@pytest.mark.parametrize("limit", [1 << 19, 20, 0])
def test_odd_texts_with_and_without_frequent_pairs(spark, plain, limit):
    pairs = odd_texts()
    docs = make_docs(spark, pairs).selectExpr("*", "1 AS row", "2 AS pairs", "3 AS links", "4 AS n_a").repartition(6)
    assert got(alignment.alignment_report(docs, limit=limit)) == expected(plain, pairs)


def test_blocks_of_pairs_and_empty_table(spark, plain, monkeypatch):
    monkeypatch.setattr(alignment, "SLICE_CHARS", 50)
    monkeypatch.setattr(alignment.row_products, "__defaults__", (7,))
    pairs = odd_texts()[:14]
    assert got(alignment.alignment_report(make_docs(spark, pairs))) == expected(plain, pairs)
    assert alignment.alignment_report(make_docs(spark, [])).collect() == []


def test_ranks_give_the_ids_of_the_file(rows):
    """The rank encoder against the library of the file's own format, odd and long texts included; other files are not taken."""
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as f:
        raw = f.read()
    slow = tokenizers.Tokenizer.from_str(raw.decode())
    slow.encode_special_tokens = True
    fast = alignment.ranked(raw)
    texts = [" " + (t or "") for _, t in rows + odd_texts()] + [" " * 30_000, "a b" * 20_000, "\n" * 9_000 + "x", "^" * 9_000, "don't we'll I'VE 12ab3"]
    assert [fast.encode_ordinary(t) for t in texts] == [e.ids for e in slow.encode_batch(texts, add_special_tokens=False)]
    spec = json.loads(raw)
    spec["model"]["merges"][10], spec["model"]["merges"][11] = spec["model"]["merges"][11], spec["model"]["merges"][10]
    assert alignment.ranked(json.dumps(spec).encode()) is None


def test_units_give_the_pieces_of_the_whole(rows, monkeypatch):
    """Remembered units against whole texts; without them, and with a memory of a few, the ids are the same."""
    files = [open(f, "rb").read() for f in alignment.default_files()]  # noqa: SIM115
    texts = [t or "" for _, t in rows + odd_texts()]
    pair = alignment.Pair(*files)
    assert pair.by_unit
    made = pair.encode(texts)
    monkeypatch.setattr(alignment, "REMEMBERED", 5)
    few = alignment.Pair(*files)
    few_made = [few.encode(texts[n:n + 7]) for n in range(0, len(texts), 7)]
    pair.by_unit, pair.ranked = False, None
    whole = pair.encode(texts)
    for side in (0, 1):
        assert [x.tolist() for x in made[side]] == [x.tolist() for x in whole[side]] == [x.tolist() for m in few_made for x in m[side]]
