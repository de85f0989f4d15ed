import hashlib
import re
from dataclasses import replace

from pyspark.sql import functions as F

from shoplens.llm import catalog, oracles, secrets
from tests.conftest import SF_SMALL
from tests.llm.conftest import edge_pairs, make_docs

#: The contract's patterns, without possessive loops, with group 2 of the first one.
BASE = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m[2]) >= 12),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 16),
)

SECRETS = [
    (20, "password = 'hunter2hunter2' and Token:\"abcdef123456\" api_key=short apikey==AAAAAAAAAAAA SECRET'  :  x.y-z_0/1+2=="),
    (21, "AKIA" + "Q7" * 8 + " AKIAAKIA12 AKIA " + "0123456789abcdef" * 3 + " deadbeef 0123456789ABCDEF"),
    (22, "token= \ttoken:=abcdefghijkl passwd  \"=zzzzzzzzzzzz tokentoken=mmmmmmmmmmmm ſecret=aaaaaaaaaaaaaaa"),
    (23, "😀é password:" + "a" * 40_000 + "0" * 15 + " " + "f" * 16),
    (24, "-----BEGIN RSA PRIVATE KEY----- ghp_" + "a1" * 12 + " eyJhbGciOi.eyJzdWIiOiIx.c2lnbmF0dXJl https://me:pass-word@host"),
    (25, "token" + " " * 5_000 + "token" + " " * 5_000 + ": abcdefghijklmno"),
    (26, "password = 'hunter2hunter2' and Token:\"abcdef123456\" api_key=short apikey==AAAAAAAAAAAA SECRET'  :  x.y-z_0/1+2=="),
]


def plain(text):
    text = text or ""
    spans = [(m.start(), n, m.end(), kind) for n, (kind, rx, ok) in enumerate(BASE) for m in rx.finditer(text) if ok(m)]
    listed = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(spans))
    return *[sum(s[1] == n for s in spans) for n in range(3)], hashlib.sha256(listed.encode()).hexdigest(), {f"{k}:{a}:{b}" for a, _, b, k in spans}


def same(rows, pairs):
    key = lambda r: (r[0] is None, r[0] or 0, r[1:6])
    found = sorted(((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.blob, r.spans) for r in rows), key=key)
    expected = sorted(((i, *plain(t)[:4], hashlib.sha256((t or "").encode()).hexdigest(), plain(t)[4]) for i, t in pairs), key=key)
    assert [f[:6] for f in found] == [e[:6] for e in expected]
    assert all(e[6] <= set(f[6].split(",")) for f, e in zip(found, expected, strict=True))


def test_report_equals_plain_patterns(spark, tmp_path, rows):
    pairs = edge_pairs() + SECRETS
    docs = make_docs(spark, pairs).selectExpr("*", "1 AS blob", "2 AS salt", "3 AS spans", "'x' AS wanted").repartition(5)
    report = secrets.secret_report(docs, secrets.scan(docs, str(tmp_path / "a"))).collect()
    same(report, pairs)
    added = next(r for r in report if r.doc_id == 24).spans
    assert [s.split(":")[0] for s in added.split(",")] == ["private-key", "hosted-token", "hex", "web-token", "url-login"]
    same(catalog.op13_secret_ledger(spark, SF_SMALL).collect(), rows)


def test_query_equals_sql(spark, duck):
    columns = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "blob"]
    found = sorted(tuple(r) for r in catalog.op13_secret_ledger(spark, SF_SMALL).select(columns).collect())
    assert found == sorted(map(tuple, duck.sql(oracles.secret_ledger()).df()[columns].values.tolist()))


def test_only_unseen_pairs_are_scanned(spark, tmp_path):
    path = str(tmp_path / "ledger")
    first, rules = make_docs(spark, SECRETS[:3]), secrets.RULES
    assert secrets.pending(first, secrets.read_ledger(spark, path), rules).count() == 3
    secrets.scan(first, path)
    # a later version of one document, an unchanged one and a copy under a new path: one new blob
    later = make_docs(spark, [(20, "now without"), SECRETS[1], (99, SECRETS[1][1])])
    todo = secrets.pending(later, secrets.read_ledger(spark, path), rules).collect()
    assert [r.text for r in todo] == ["now without"] and len(todo[0].wanted) == len(rules)
    ledger = secrets.scan(later, path)
    assert ledger.count() == 4 and ledger.select(F.explode("tried")).count() == 4 * len(rules)
    report = {r.doc_id: r for r in secrets.secret_report(later, ledger).collect()}
    assert report[20].spans == "" and report[99].spans == report[21].spans != ""
    # a rule moves on: only this rule is tried again, on every blob, and its old findings no longer count
    moved = tuple(replace(r, version=2, pattern="[0-9a-f]{40,}+") if r.name == "hex" else r for r in rules)
    todo = secrets.pending(first, ledger, moved).collect()
    assert len(todo) == 3 and all([(w.rule, w.version) for w in r.wanted] == [("hex", 2)] for r in todo)
    again = secrets.scan(first, path, moved)
    assert secrets.pending(first, again, moved).count() == 0
    report = {r.doc_id: r for r in secrets.secret_report(first, again, moved).collect()}
    assert report[21].n_hex == 1 and report[21].n_access == 1 and "hex:" in report[21].spans
    old = {r.doc_id: r for r in secrets.secret_report(first, again, rules).collect()}
    assert old[21].n_hex == plain(SECRETS[1][1])[2]


def test_lost_and_repeated_scans(spark, tmp_path):
    path = str(tmp_path / "ledger")
    docs = make_docs(spark, SECRETS)
    twice = secrets.scan_blobs(secrets.pending(docs, secrets.read_ledger(spark, path)))
    twice.write.mode("append").parquet(path)
    twice.write.mode("append").parquet(path)  # two scans at once
    same(secrets.secret_report(docs, secrets.read_ledger(spark, path)).collect(), SECRETS)
    empty = docs.limit(0)
    assert secrets.secret_report(empty, secrets.scan(empty, str(tmp_path / "none"))).collect() == []
