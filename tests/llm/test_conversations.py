import hashlib
import itertools
import random
import re
import zlib

from pyspark.sql import types as T

from shoplens.llm import catalog, conversations, oracles
from shoplens.llm.conversations import MUST_GO, SOUND, TRUNCATED, Repair, search, suffix_bounds
from tests.conftest import SF_SMALL

ROWS = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
                     T.StructField("text", T.StringType())])
COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def enumerated(rows):
    """Every combination of edits of a few rows with up to two inserts at each place: the least (cost, audit)."""
    gaps = ["", "u", "a", "ua", "au"]
    best = None
    for edits in itertools.product("KUAD", repeat=len(rows)):
        if any(e != "D" and fault == MUST_GO for e, (_, fault) in zip(edits, rows, strict=True)):
            continue
        for added in itertools.product(gaps, repeat=len(rows) + 1):
            roles = cost = audit = None
            roles, cost, audit = added[0], 3 * len(added[0]), "I" * len(added[0])
            for e, (code, fault), more in zip(edits, rows, added[1:], strict=True):
                cost += {"K": 0, "U": 3, "A": 3, "D": 4}[e] + (3 if e != "D" and fault == TRUNCATED else 0) + 3 * len(more)
                roles += {"K": code, "U": "u", "A": "a", "D": ""}[e] + more
                audit += {"U": "R", "A": "R"}.get(e, e) + "I" * len(more)
            if re.fullmatch("(s?(ua)+)?", roles) and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


def stepwise(rows):
    """The same by a table over (rows, role state), for sequences too long to enumerate."""
    after = (2, 2, 3, 2)
    table = {0: (0, "")}

    def inserted(t):
        for _ in range(2):
            for q, (c, a) in list(t.items()):
                t[after[q]] = min(t.get(after[q], (c + 3, a + "I")), (c + 3, a + "I"))
        return t

    for code, fault in rows:
        new = {}
        for q, (c, a) in inserted(dict(table)).items():
            moves = [(q, c + 4, a + "D")]
            if fault != MUST_GO:
                more = 3 if fault == TRUNCATED else 0
                moves.append((after[q], c + 3 + more, a + "R"))
                if (code == "s" and q == 0) or (code == "u" and q != 2) or (code == "a" and q == 2):
                    moves.append((1 if code == "s" else after[q], c + more, a + "K"))
            for to, cost, audit in moves:
                new[to] = min(new.get(to, (cost, audit)), (cost, audit))
        table = new
    return min(v for q, v in inserted(table).items() if q in (0, 3))


def random_rows(rng, n):
    return [(rng.choice("ssuuuaaax"), rng.choice([SOUND] * 4 + [MUST_GO, TRUNCATED, TRUNCATED])) for _ in range(n)]


def test_search_equals_full_enumeration():
    rng = random.Random(3)
    for _ in range(60):
        rows = random_rows(rng, rng.randint(0, 3))
        assert search(rows, [(0, "", 0)]) == enumerated(rows), rows


def test_search_equals_table_and_bounds_hold():
    rng = random.Random(4)
    for _ in range(400):
        rows = random_rows(rng, rng.randint(0, 14))
        found = search(rows, [(0, "", 0)])
        assert found == stepwise(rows), rows
        assert suffix_bounds(rows, None)[0][0] <= found[0]


def test_blocks_give_the_same_edits_and_digest(monkeypatch):
    rng = random.Random(5)
    names = {"s": "system", "u": "user", "a": "assistant", "x": "tool"}
    for n in (0, 1, 63, 64, 65, 300):
        rows = random_rows(rng, n)
        whole, parted = Repair(), Repair()
        for made, size in ((whole, 10_000), (parted, 7)):
            monkeypatch.setattr(conversations, "BLOCK", size)
            for t, (code, fault) in enumerate(rows):
                made.add(t, names[code], f"text {t}", {SOUND: 0, MUST_GO: 1, TRUNCATED: 3}[fault])
        a, b = whole.finish(), parted.finish()
        assert a == b and (a[5], a[6]) == stepwise(rows)
        assert len(parted.held) == 0


def plain(rows):
    """The contract row by row: damage, faults, edits by the table above, repaired lines."""
    by = {}
    for conv, turn, role, text in rows:
        alive = by.setdefault(conv, [])
        shown = [" " if x is None else str(x) for x in (conv, turn)]
        hit = zlib.crc32(":".join(shown).encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if hit == 0:
            continue
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        alive.extend([(turn, "user" if hit == 4 else role, text)] * (2 if hit == 3 else 1))
    out = []
    for conv, kept in by.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, coded, counts = set(), [], [0, 0, 0]
        for _, role, text in kept:
            bare = text.rstrip(" \t\n\x0b\x0c\r")
            fault = 0 if not bare else 1 if (role, text) in seen else 2 if bare[-1] not in ".!?" else None
            if fault is not None:
                counts[fault] += 1
            seen.add((role, text))
            coded.append((role[:1] if role[:1] in ("s", "u", "a") else "x", {0: MUST_GO, 1: MUST_GO, 2: TRUNCATED, None: SOUND}[fault]))
        turns = [t for t, _, _ in kept if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(kept))
        cost, audit = stepwise(coded)
        lines, at, last = [], iter(kept), ""
        for e in audit:
            row = None if e == "I" else next(at)
            if e != "D":
                role = row[1] if e == "K" else "assistant" if last == "u" else "user"
                lines.append(role + ":" + (row[2] if row else ""))
                last = role[:1]
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0))


def reported(df):
    return sorted(((r.conv_id, *(r[c] for c in COLUMNS)) for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0))


def test_query_equals_plain_version_and_sql(spark, duck):
    table = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    found = reported(catalog.op12_conversation_repair(spark, SF_SMALL))
    assert found == plain([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])
    duck.execute(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM read_parquet('{SF_SMALL}/conversations.parquet')")
    sql = duck.sql(oracles.conversation_repair()).df()
    assert sorted(map(tuple, sql[["conv_id", *COLUMNS]].values.tolist())) == found


def test_odd_rows(spark):
    rng = random.Random(6)
    roles = ["user", "assistant", "system", "", None, "tool", "User", "usher"]
    texts = ["Yes.", "no", "", None, "  \t", "What?  ", "Well!\n", "y" * 30_000 + ".", "Ünï 😀.", "a\x00b."]
    rows = [(rng.choice([None, *range(40)]), rng.choice([None, 0, 1, 2, 3, 9, -4]), rng.choice(roles), rng.choice(texts)) for _ in range(400)]
    rows += rows[:50] + [(500, t, "user" if t % 2 == 0 else "assistant", f"turn {t}.") for t in range(400)]
    table = spark.createDataFrame(rows, ROWS)
    expected = plain(rows)
    assert reported(conversations.repair_conversations(conversations.damage(table.repartition(7)), alive="alive")) == expected
    clashing = table.selectExpr("*", "1 AS alive", "'x' AS hit", "2 AS copy", "3 AS fault", "4 AS time", "5 AS cost")
    assert reported(conversations.repair_conversations(conversations.damage(clashing), alive="alive")) == expected
    assert conversations.repair_conversations(table.limit(0)).collect() == []
    undamaged = {r.conv_id: r for r in conversations.repair_conversations(clashing).collect()}
    assert undamaged[500].cost == 0 and undamaged[500].audit == "K" * 400
