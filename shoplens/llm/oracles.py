"""DuckDB SQL for the registered text queries that SQL can express over whole tables."""

from __future__ import annotations

from .licenses import TEMPLATES, K

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _templates() -> str:
    cells = []
    for n, t in enumerate(TEMPLATES):
        words = t.words.split()
        for p in range(len(words) - K + 1):
            cells.append(f"({n}, '{t.label}', {str(t.base).lower()}, {len(words) - K + 1}, {p}, '{' '.join(words[p:p + K])}')")
    return ", ".join(cells)


def license_scan() -> str:
    """Diagonal votes over the words themselves instead of their hashes."""
    return rf"""
    WITH positions(tpl, label, base, grams, tpos, gram) AS (VALUES {_templates()}),
    tokens AS (
      SELECT row_number() OVER () AS rid, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM documents),
    grams_ AS (
      SELECT rid, unnest(generate_series(0, len(w) - 2)) AS pos,
             unnest(list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1])) AS gram
      FROM tokens WHERE len(w) >= 2),
    votes AS (
      SELECT rid, tpl, label, base, grams, pos - tpos AS diagonal, count(*) AS votes, list(tpos) AS places
      FROM grams_ JOIN positions USING (gram) GROUP BY ALL),
    kept AS (SELECT * FROM votes WHERE NOT base OR votes = grams),
    marked AS (
      SELECT *, CASE WHEN base OR lag(diagonal) OVER o IS NULL OR diagonal - lag(diagonal) OVER o > 3 THEN 1 ELSE 0 END AS opens
      FROM kept WINDOW o AS (PARTITION BY rid, tpl ORDER BY diagonal)),
    numbered AS (SELECT *, sum(opens) OVER (PARTITION BY rid, tpl ORDER BY diagonal) AS span FROM marked),
    spans AS (
      SELECT rid, label, base, greatest(min(diagonal), 0) AS start, len(list_distinct(flatten(list(places)))) / grams AS cover
      FROM numbered GROUP BY rid, tpl, label, base, grams, span
      HAVING len(list_distinct(flatten(list(places)))) / grams >= 0.8),
    reports AS (
      SELECT rid, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
             list_aggregate(list_sort(list(DISTINCT label) FILTER (base)), 'string_agg', ',') AS base_labels,
             list_aggregate(list_sort(list(DISTINCT label)), 'string_agg', ',') AS labels, max(cover) AS score
      FROM spans GROUP BY rid)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
           CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
           coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
    FROM tokens LEFT JOIN reports USING (rid)"""


def sharding() -> str:
    """Every capacity of the possible range is tried by eight greedy look-ups; the smallest that covers all wins."""
    steps = "".join(
        f", s{n} AS (SELECT c, coalesce(max(upto), 0) AS p FROM (SELECT c, p, upto FROM s{n - 1} ASOF LEFT JOIN running ON s{n - 1}.p + s{n - 1}.c >= running.upto) GROUP BY c)"
        for n in range(1, 9))
    cuts = "".join(
        f", k{n} AS (SELECT coalesce(max(upto), 0) AS p, max(key) AS key FROM running WHERE upto <= (SELECT p FROM k{n - 1}) + (SELECT c FROM best))"
        for n in range(1, 9))
    shard = " + ".join(f"CASE WHEN key > (SELECT key FROM k{n}) THEN 1 ELSE 0 END" for n in range(1, 8))
    return f"""
    WITH rows_ AS (
      SELECT doc_id, coalesce(md5(text), '') AS key, coalesce(strlen(text), 0) + 1 AS size, text FROM documents),
    groups AS (SELECT key, CAST(sum(size) AS BIGINT) AS bytes FROM rows_ GROUP BY key),
    running AS (SELECT key, CAST(sum(bytes) OVER (ORDER BY key) AS BIGINT) AS upto FROM groups),
    range_ AS (
      SELECT greatest(CAST(ceil(sum(bytes) / 8.0) AS BIGINT), max(bytes)) AS low, CAST(ceil(sum(bytes) / 8.0) AS BIGINT) + max(bytes) AS high,
             CAST(sum(bytes) AS BIGINT) AS total FROM groups),
    s0 AS (SELECT unnest(generate_series(low, high)) AS c, CAST(0 AS BIGINT) AS p FROM range_){steps},
    best AS (SELECT min(c) AS c FROM s8 WHERE p >= (SELECT total FROM range_)),
    k0 AS (SELECT CAST(0 AS BIGINT) AS p, '' AS key){cuts}
    SELECT doc_id, CAST(size AS BIGINT) AS size, 'bytes' AS law, CAST({shard} AS INTEGER) AS shard FROM rows_"""


#: The patterns as the contract states them (no possessive loops, no anchors), and the method's own kinds.
PII_PATTERNS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)"),
    ("card", r"[0-9](?:[\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    ("iban", r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?"),
    ("token", r"[0-9A-Fa-f]{32,}"),
)


def pii() -> str:
    """Matches and the gaps between them, places as running sums of lengths, checks in SQL."""
    from .pii import KINDS, WINDOW

    found = " UNION ALL ".join(
        f"SELECT rid, {n} AS kind, '{name}' AS name, unnest(generate_series(1, len(m))) AS i, unnest(m) AS value, unnest(g[1:len(m)]) AS gap, unnest(g[2:len(m) + 1]) AS after "
        f"FROM (SELECT rid, regexp_extract_all(text, '{rx}') AS m, string_split_regex(text, '{rx}') AS g FROM docs) WHERE len(m) > 0"
        for n, (name, rx) in enumerate(PII_PATTERNS))
    context = " ".join(f"WHEN {n} THEN regexp_matches(before, '(?i)(?:{k.context})')" for n, k in enumerate(KINDS))
    return rf"""
    WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
    found AS ({found}),
    placed AS (
      SELECT *, regexp_replace(value, '[^0-9]', '', 'g') AS digits, replace(value, ' ', '') AS plain,
             right(gap, {WINDOW}) AS before, left(after, 1) AS next,
             sum(length(gap) + length(value)) OVER (PARTITION BY rid, kind ORDER BY i) AS stop
      FROM found),
    edged AS (SELECT *, NOT regexp_matches(before, '[A-Za-z0-9]$') AND NOT regexp_matches(next, '^[A-Za-z0-9]') AS edge FROM placed),
    checked AS (
      SELECT rid, kind, name, CAST(stop - length(value) AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop, CASE kind {context} END AS near_word
      FROM edged WHERE CASE name
        WHEN 'ip' THEN list_bool_and(list_transform(string_split(value, '.'), lambda x: length(ltrim(x, '0')) <= 3 AND coalesce(TRY_CAST(right('000' || x, 3) AS INTEGER), 999) <= 255))
        WHEN 'card' THEN length(digits) BETWEEN 16 AND 19 AND list_sum(list_transform(generate_series(0, length(digits) - 1),
          lambda i: CASE WHEN i % 2 = 0 THEN CAST(reverse(digits)[i + 1] AS INTEGER)
                         WHEN CAST(reverse(digits)[i + 1] AS INTEGER) > 4 THEN CAST(reverse(digits)[i + 1] AS INTEGER) * 2 - 9
                         ELSE CAST(reverse(digits)[i + 1] AS INTEGER) * 2 END)) % 10 = 0
        WHEN 'phone' THEN length(digits) BETWEEN 8 AND 15
        WHEN 'iban' THEN edge AND length(plain) BETWEEN 15 AND 34 AND list_reduce(list_transform(
          string_split(array_to_string(list_transform(string_split(plain[5:] || plain[:4], ''),
            lambda c: CASE WHEN ascii(c) < 58 THEN c ELSE CAST(ascii(c) - 55 AS VARCHAR) END), ''), ''), lambda d: CAST(d AS INTEGER)),
          lambda a, b: (a * 10 + b) % 97) = 1
        WHEN 'token' THEN edge AND regexp_matches(before, '(?i)(?:token|secret|passw(?:or)?d|key)[^A-Za-z0-9]{{1,6}}$')
        ELSE true END),
    reports AS (
      SELECT rid, count(*) FILTER (kind = 0) AS n_email, count(*) FILTER (kind = 1) AS n_ip, count(*) FILTER (kind = 2) AS n_card,
             count(*) FILTER (kind = 3) AS n_phone,
             string_agg(name || ':' || start || ':' || stop, ',' ORDER BY kind, start) FILTER (kind < 4) AS base,
             string_agg(name || ':' || start || ':' || stop, ',' ORDER BY kind, start) AS spans,
             max(50 + CASE WHEN name IN ('card', 'iban') THEN 30 ELSE 10 END + CASE WHEN near_word THEN 20 ELSE 0 END) / 100.0 AS best
      FROM checked GROUP BY rid)
    SELECT doc_id, CAST(coalesce(n_email, 0) AS BIGINT) AS n_email, CAST(coalesce(n_ip, 0) AS BIGINT) AS n_ip, CAST(coalesce(n_card, 0) AS BIGINT) AS n_card,
           CAST(coalesce(n_phone, 0) AS BIGINT) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
           CAST(coalesce(best, 0) AS DOUBLE) AS best_score
    FROM docs LEFT JOIN reports USING (rid)"""


def conversation_repair() -> str:
    """Best edits by dynamic programming over (rows decided, role state), with the repaired lines carried along; the checksum
    of the damage is computed bit by bit."""
    crc = ("xor(list_reduce(list_prepend(4294967295, list_transform(string_split(key, ''), lambda c: CAST(ascii(c) AS BIGINT))), "
           "lambda acc, b: list_reduce([xor(acc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)")
    white = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return rf"""
    WITH RECURSIVE keyed AS (
      SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
    hits AS (SELECT *, {crc} % 20 AS hit FROM keyed),
    damaged AS (
      SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
             CASE hit WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
             unnest(CASE WHEN hit = 3 THEN [0, 1] ELSE [0] END) AS copy
      FROM hits WHERE hit <> 0),
    ended AS (
      SELECT *, rtrim(text, {white}) AS body, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i
      FROM damaged),
    faults AS (
      SELECT *, CASE WHEN body = '' THEN 1 WHEN seen > 1 THEN 2 WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
             left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
      FROM ended),
    counts AS (
      SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
             count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
             count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
      FROM faults GROUP BY conv_id),
    inserts(p, letters, cost, q, added) AS (VALUES
      (0, '', 0, 0, []::VARCHAR[]), (1, '', 0, 1, []), (2, '', 0, 2, []), (3, '', 0, 3, []),
      (0, 'I', 3, 2, ['user:']), (1, 'I', 3, 2, ['user:']), (2, 'I', 3, 3, ['assistant:']), (3, 'I', 3, 2, ['user:']),
      (0, 'II', 6, 3, ['user:', 'assistant:']), (1, 'II', 6, 3, ['user:', 'assistant:'])),
    best AS (
      SELECT conv_id, CAST(0 AS BIGINT) AS i, 0 AS state, CAST(0 AS BIGINT) AS cost, '' AS audit, []::VARCHAR[] AS lines FROM counts
      UNION ALL
      SELECT conv_id, i, state, cost, audit, lines FROM (
        SELECT b.conv_id, f.i, e.state, b.cost + s.cost + e.cost AS cost, b.audit || s.letters || e.letter AS audit,
               list_concat(list_concat(b.lines, s.added), e.line) AS lines
        FROM best b JOIN inserts s ON s.p = b.state JOIN faults f ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND f.i = b.i + 1,
        LATERAL (
          SELECT 'D' AS letter, 4 AS cost, s.q AS state, []::VARCHAR[] AS line
          UNION ALL SELECT 'R', CASE WHEN f.fault = 3 THEN 6 ELSE 3 END, CASE WHEN s.q = 2 THEN 3 ELSE 2 END,
                           [CASE WHEN s.q = 2 THEN 'assistant:' ELSE 'user:' END || f.text] WHERE f.fault NOT IN (1, 2)
          UNION ALL SELECT 'K', CASE WHEN f.fault = 3 THEN 3 ELSE 0 END, CASE f.initial WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END, [f.role || ':' || f.text]
                    WHERE f.fault NOT IN (1, 2) AND CASE f.initial WHEN 's' THEN s.q = 0 WHEN 'u' THEN s.q <> 2 WHEN 'a' THEN s.q = 2 ELSE false END) e)
      QUALIFY row_number() OVER (PARTITION BY conv_id, i, state ORDER BY cost, audit) = 1),
    ends AS (
      SELECT b.conv_id, b.cost + s.cost AS cost, b.audit || s.letters AS audit, list_concat(b.lines, s.added) AS lines
      FROM best b JOIN counts c ON c.conv_id IS NOT DISTINCT FROM b.conv_id AND c.n = b.i JOIN inserts s ON s.p = b.state AND s.q IN (0, 3)
      QUALIFY row_number() OVER (PARTITION BY b.conv_id ORDER BY b.cost + s.cost, b.audit || s.letters) = 1)
    SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
           CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
           CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit,
           sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) o
    LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM o.conv_id"""


#: The patterns as the contract states them, in the order of kinds, and the method's own; then what a match must pass.
SECRET_PATTERNS = (
    ("assign", """([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"""
               """["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)""", "length(regexp_extract(value, '[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)$', 1)) >= 12"),
    ("access", "AKIA[A-Z0-9]+", "length(value) >= 18"),
    ("hex", "[0-9a-f]+", "length(value) >= 16"),
    ("private-key", "-----BEGIN ([A-Z]+ ){0,3}PRIVATE KEY-----", "true"),
    ("hosted-token", "(ghp|gho|ghs|ghu|glpat|xox[abprs])[_-][A-Za-z0-9_-]{16,}", "true"),
    ("web-token", r"eyJ[A-Za-z0-9_-]{6,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", "true"),
    ("url-login", r"://[A-Za-z0-9._~-]{1,64}:[^\x00-\x20/@:]{3,128}@", "true"),
)


def secret_ledger() -> str:
    """Matches of whole texts, with no blobs and no ledger."""
    found = " UNION ALL ".join(
        f"SELECT rid, {n} AS kind, '{name}' AS name, i, value, gap FROM (SELECT rid, unnest(generate_series(1, len(m))) AS i, unnest(m) AS value, unnest(g[1:len(m)]) AS gap "
        f"FROM (SELECT rid, regexp_extract_all(text, '{rx}') AS m, string_split_regex(text, '{rx}') AS g FROM docs) WHERE len(m) > 0)"
        for n, (name, rx, _) in enumerate(SECRET_PATTERNS))
    checks = " ".join(f"WHEN {n} THEN {check}" for n, (_, _, check) in enumerate(SECRET_PATTERNS))
    return f"""
    WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
    found AS ({found}),
    placed AS (SELECT *, sum(length(gap) + length(value)) OVER (PARTITION BY rid, kind ORDER BY i) AS stop FROM found),
    kept AS (SELECT rid, kind, name, CAST(stop - length(value) AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop FROM placed WHERE CASE kind {checks} END),
    reports AS (
      SELECT rid, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
             string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, kind) FILTER (kind < 3) AS base,
             string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, kind) AS spans
      FROM kept GROUP BY rid)
    SELECT doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign, CAST(coalesce(n_access, 0) AS BIGINT) AS n_access,
           CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, sha256(text) AS blob
    FROM docs LEFT JOIN reports USING (rid)"""


def all_oracles() -> dict[str, str]:
    return {"op1_license_scan": license_scan(), "op7_pii": pii(), "op12_conversation_repair": conversation_repair(),
            "op13_secret_ledger": secret_ledger()}
