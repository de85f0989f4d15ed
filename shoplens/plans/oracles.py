"""Oracle SQL (DuckDB dialect) for every registered query that has an SQL form.

The texts are assembled from shared CTE fragments so that each definition (adapter, copy
removal, flags, RFM, ...) is written once. They read the pre-registered views
``lineitem orders part supplier nation region``.
"""

from __future__ import annotations

from ..params import DEFAULT, PRODUCT_LIKE_PATTERN, SCHEMA_VERSION, Params

LINE_COLS = "invoice_no, stock_code, description, quantity, invoice_date, unit_price, customer_id, country"
ORDER_ALL = ", ".join(f"{c} ASC NULLS FIRST" for c in LINE_COLS.split(", "))


def _strip(c: str) -> str:
    space = r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
    return f"regexp_replace({c}, '^{space}+|{space}+$', '', 'g')"


def ts(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%dT%H:%M:%S')"


def day(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d')"


def money(c: str) -> str:
    return f"round(CAST({c} AS DOUBLE), 4)"


def dbl(c: str, digits: int = 6) -> str:
    return f"round(CAST({c} AS DOUBLE), {digits})"


def base_ctes(p: Params = DEFAULT) -> dict[str, str]:
    """Named CTE bodies in dependency order."""
    flags = f"""
        coalesce(starts_with(invoice_no, 'C'), false) AS is_cancellation,
        coalesce(quantity <= 0, false) AS is_nonpositive_quantity,
        coalesce(unit_price <= 0, false) AS is_nonpositive_price,
        NOT coalesce(starts_with(invoice_no, 'C'), false) AND NOT coalesce(quantity <= 0, false)
            AND NOT coalesce(unit_price <= 0, false) AS is_valid_positive_purchase,
        coalesce(regexp_full_match(stock_code, '{PRODUCT_LIKE_PATTERN}'), false) AS is_product_like"""
    return {
        "adapted": """
            SELECT CASE WHEN l.l_returnflag = 'R' THEN 'C' || CAST(l.l_orderkey AS VARCHAR)
                        ELSE CAST(l.l_orderkey AS VARCHAR) END AS invoice_no,
                   CASE WHEN p.p_type = 'PROMO' THEN 'PROMO' || CAST(l.l_partkey AS VARCHAR)
                        ELSE printf('%05d', l.l_partkey) END AS stock_code,
                   p.p_name AS description,
                   CAST(CASE WHEN l.l_returnflag = 'R' THEN -l.l_quantity ELSE l.l_quantity END AS BIGINT) AS quantity,
                   o.o_orderdate AS invoice_date,
                   CASE WHEN l.l_partkey % 50 = 0 THEN 0.0 ELSE l.l_extendedprice / l.l_quantity END AS unit_price,
                   CASE WHEN o.o_orderpriority = '5-LOW' THEN NULL ELSE CAST(o.o_custkey AS VARCHAR) END AS customer_id,
                   r.r_name AS country,
                   l.l_orderkey AS l_orderkey
            FROM lineitem l
            JOIN orders o ON l.l_orderkey = o.o_orderkey
            JOIN part p ON l.l_partkey = p.p_partkey
            JOIN supplier s ON l.l_suppkey = s.s_suppkey
            JOIN nation n ON s.s_nationkey = n.n_nationkey
            JOIN region r ON n.n_regionkey = r.r_regionkey""",
        "raw_lines": f"""
            SELECT {LINE_COLS} FROM adapted
            UNION ALL
            SELECT {LINE_COLS} FROM adapted WHERE l_orderkey % 50 = 0""",
        "dedup": f"SELECT {LINE_COLS}, count(*) AS copies FROM raw_lines GROUP BY ALL",
        "norm_raw": f"""
            SELECT {_strip('invoice_no')} AS invoice_no, upper({_strip('stock_code')}) AS stock_code,
                   description, quantity, invoice_date, unit_price,
                   {_strip('customer_id')} AS customer_id, {_strip('country')} AS country,
                   CAST(quantity * unit_price AS DECIMAL(18,4)) AS line_amount
            FROM raw_lines""",
        "norm": f"""
            SELECT {_strip('invoice_no')} AS invoice_no, upper({_strip('stock_code')}) AS stock_code,
                   description, quantity, invoice_date, unit_price,
                   {_strip('customer_id')} AS customer_id, {_strip('country')} AS country,
                   CAST(quantity * unit_price AS DECIMAL(18,4)) AS line_amount
            FROM dedup""",
        "known": f"""
            SELECT *, {flags}
            FROM norm WHERE customer_id IS NOT NULL AND customer_id <> ''""",
        "rfm": f"""
            SELECT customer_id,
                   coalesce(string_agg(DISTINCT country, ' | ' ORDER BY country), '') AS country_display,
                   max(CASE WHEN is_valid_positive_purchase THEN CAST(invoice_date AS DATE) END) AS last_purchase,
                   CAST(date_diff('day', max(CASE WHEN is_valid_positive_purchase THEN CAST(invoice_date AS DATE) END),
                        DATE '{p.reference_date}') AS BIGINT) AS recency,
                   CAST(count(DISTINCT CASE WHEN is_valid_positive_purchase THEN invoice_no END) AS BIGINT) AS frequency,
                   sum(CASE WHEN is_valid_positive_purchase THEN line_amount END) AS gross_monetary,
                   sum(line_amount) AS net_monetary
            FROM known GROUP BY customer_id
            HAVING bool_or(is_valid_positive_purchase)""",
    }


def with_ctes(body: str, names: list[str], p: Params = DEFAULT, extra: dict[str, str] | None = None) -> str:
    """``WITH`` clause holding the named base CTEs (plus dependencies) and ``extra`` ones."""
    ctes = base_ctes(p)
    order = list(ctes)
    deps = {
        "raw_lines": ["adapted"],
        "dedup": ["raw_lines"],
        "norm_raw": ["raw_lines"],
        "norm": ["dedup"],
        "known": ["norm"],
        "rfm": ["known"],
    }
    needed: set[str] = set()

    def need(n: str) -> None:
        if n in needed or n not in ctes:
            return
        for d in deps.get(n, []):
            need(d)
        needed.add(n)

    for n in names:
        need(n)
    parts = [f"{n} AS ({ctes[n]})" for n in order if n in needed]
    for n, text in (extra or {}).items():
        parts.append(f"{n} AS ({text})")
    return "WITH " + ",\n".join(parts) + "\n" + body


def oracle_texts(p: Params = DEFAULT) -> dict[str, str]:
    q: dict[str, str] = {}
    q["rfm_profile"] = with_ctes(
        f"""SELECT customer_id, country_display, {day('last_purchase')} AS last_purchase_date, recency, frequency,
                   {money('gross_monetary')} AS gross_monetary, {money('net_monetary')} AS net_monetary
            FROM rfm""",
        ["rfm"],
        p,
    )
    q["source_facts"] = with_ctes(
        f"""SELECT CAST(sum(copies) AS BIGINT) AS raw_rows, CAST(8 AS BIGINT) AS fields,
                   CAST(count(DISTINCT invoice_no) AS BIGINT) AS unique_invoices,
                   {day('min(invoice_date)')} AS date_start, {day('max(invoice_date)')} AS date_end,
                   CAST(coalesce(sum(CASE WHEN customer_id IS NULL THEN copies END), 0) AS BIGINT) AS missing_customer_rows,
                   {dbl('sum(CASE WHEN customer_id IS NULL THEN copies END) / sum(copies)')} AS missing_customer_share,
                   CAST(sum(copies - 1) AS BIGINT) AS duplicate_extra_rows,
                   CAST(count(*) AS BIGINT) AS deduplicated_rows
            FROM dedup""",
        ["dedup"],
        p,
    )
    line_out = LINE_COLS.replace("invoice_date", f"{ts('invoice_date')} AS invoice_date")
    q["duplicate_audit"] = with_ctes(
        f"""SELECT {line_out}, CAST(copies AS BIGINT) AS copies, CAST(copies - 1 AS BIGINT) AS extra_copies
            FROM dedup WHERE copies > 1""",
        ["dedup"],
        p,
    )
    numbered = f"""
        SELECT {LINE_COLS}, CAST(min(rn) AS BIGINT) AS source_row_number, CAST(count(*) AS BIGINT) AS copies
        FROM (SELECT *, row_number() OVER (ORDER BY {ORDER_ALL}) + 1 AS rn FROM raw_lines)
        GROUP BY ALL"""
    q["lines_deduplicated"] = with_ctes(
        f"SELECT source_row_number, {line_out}, copies FROM numbered",
        ["raw_lines"],
        p,
        {"numbered": numbered},
    )
    flags = "is_cancellation, is_valid_positive_purchase, is_nonpositive_quantity, is_nonpositive_price, is_product_like"
    flagged_line_out = line_out
    q["lines_flagged"] = with_ctes(
        f"""SELECT CAST(row_number() OVER (ORDER BY source_row_number) AS BIGINT) AS line_id, source_row_number,
                   {flagged_line_out}, {money('line_amount')} AS line_amount, {flags}
            FROM (
              SELECT source_row_number, {_strip('invoice_no')} AS invoice_no, upper({_strip('stock_code')}) AS stock_code,
                     description, quantity, invoice_date, unit_price,
                     {_strip('customer_id')} AS customer_id, {_strip('country')} AS country,
                     CAST(quantity * unit_price AS DECIMAL(18,4)) AS line_amount
              FROM numbered) n0,
            LATERAL (SELECT
                coalesce(starts_with(n0.invoice_no, 'C'), false) AS is_cancellation,
                coalesce(n0.quantity <= 0, false) AS is_nonpositive_quantity,
                coalesce(n0.unit_price <= 0, false) AS is_nonpositive_price,
                coalesce(regexp_full_match(n0.stock_code, '{PRODUCT_LIKE_PATTERN}'), false) AS is_product_like) f,
            LATERAL (SELECT NOT f.is_cancellation AND NOT f.is_nonpositive_quantity AND NOT f.is_nonpositive_price
                       AS is_valid_positive_purchase) v
            WHERE customer_id IS NOT NULL AND customer_id <> ''""",
        ["raw_lines"],
        p,
        {"numbered": numbered},
    )
    q["csv_lines"] = q["lines_flagged"]  # the same rows by way of CSV files in the order of their columns
    q["customer_countries"] = with_ctes(
        f"""SELECT customer_id, country, CAST(count(*) AS BIGINT) AS transaction_lines,
                   CAST(count(DISTINCT invoice_no) AS BIGINT) AS distinct_invoices,
                   {money('sum(line_amount)')} AS net_monetary
            FROM known WHERE customer_id IN (SELECT customer_id FROM rfm)
            GROUP BY customer_id, country""",
        ["rfm"],
        p,
    )
    return q


# ---------------------------------------------------------------- model oracles
def net_d(c: str = "net_monetary") -> str:
    """Decimal money to a correctly rounded double (via text, as Spark's cast does)."""
    return f"CAST(CAST({c} AS VARCHAR) AS DOUBLE)"


def draw_sql(seed: str, init: str, step: str, cid: str = "customer_id") -> str:
    key = f"CAST({seed} AS VARCHAR) || '|' || CAST({init} AS VARCHAR) || '|' || CAST({step} AS VARCHAR) || '|' || {cid}"
    return f"((CAST('0x' || substr(md5({key}), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0)"


def d2_sql(px: str, py: str, pz: str, cx: str, cy: str, cz: str, rounded: bool = True) -> str:
    s = f"({px} - {cx}) * ({px} - {cx}) + ({py} - {cy}) * ({py} - {cy}) + ({pz} - {cz}) * ({pz} - {cz})"
    return f"round({s}, 10)" if rounded else s


def prep_ctes(quantile: float | None, src: str = "rfm", prefix: str = "") -> dict[str, str]:
    """Caps, z-scores and points of one clustering input (``prefix`` names the CTEs)."""
    if quantile is None:
        caps = "SELECT CAST(NULL AS DOUBLE) AS fcap, CAST(NULL AS DOUBLE) AS mcap"
        fc, mc = "f", "m"
        ff, mf = "false", "false"
    else:
        caps = f"""SELECT quantile_cont(CAST(frequency AS DOUBLE), {quantile}) AS fcap,
                          quantile_cont({net_d()}, {quantile}) AS mcap FROM {src}"""
        fc, mc = "least(f, fcap)", "least(m, mcap)"
        ff, mf = "f > fcap", "m > mcap"
    P = prefix

    def exact(v: str, i: int = 0) -> str:
        """Decimal sum of a double as a double; whole-number sum and sum of squares of its 8 places."""
        unit = f"CAST(CAST(CAST({v} AS DECIMAL(18,8)) AS DECIMAL(37,8)) * 100000000 AS HUGEINT)"
        return f"CAST(CAST(sum(CAST({v} AS DECIMAL(38,10))) AS VARCHAR) AS DOUBLE) AS t{i}, sum({unit}) AS u{i}, sum({unit} * {unit}) AS q{i}"

    def spread(i: int) -> str:
        return f"sqrt(CAST(CAST(n * CAST(q{i} AS HUGEINT) - CAST(u{i} AS HUGEINT) * CAST(u{i} AS HUGEINT) AS VARCHAR) AS DOUBLE)) / (CAST(n AS DOUBLE) * 100000000.0::DOUBLE)"

    return {
        f"{P}caps": caps,
        f"{P}capped": f"""
            SELECT r.*, {fc} AS frequency_capped, {mc} AS net_monetary_capped,
                   {ff} AS frequency_capped_flag, {mf} AS monetary_capped_flag,
                   ({ff}) OR ({mf}) AS any_capped_flag
            FROM (SELECT *, CAST(frequency AS DOUBLE) AS f, {net_d()} AS m FROM {src}) r, {P}caps""",
        f"{P}stats": f"""
            SELECT t0 / CAST(n AS DOUBLE) AS m0, t1 / CAST(n AS DOUBLE) AS m1, t2 / CAST(n AS DOUBLE) AS m2, {spread(0)} AS s0, {spread(1)} AS s1, {spread(2)} AS s2
            FROM (SELECT CAST(count(*) AS HUGEINT) AS n, {exact("CAST(recency AS DOUBLE)")},
                         {exact("frequency_capped", 1)}, {exact("net_monetary_capped", 2)} FROM {P}capped)""",
        f"{P}scaled": f"""
            SELECT c.*,
                   round((CAST(recency AS DOUBLE) - m0) / CASE WHEN s0 = 0 OR s0 IS NULL THEN 1 ELSE s0 END, 10) AS scaled_recency,
                   round((frequency_capped - m1) / CASE WHEN s1 = 0 OR s1 IS NULL THEN 1 ELSE s1 END, 10) AS scaled_frequency,
                   round((net_monetary_capped - m2) / CASE WHEN s2 = 0 OR s2 IS NULL THEN 1 ELSE s2 END, 10) AS scaled_net_monetary
            FROM {P}capped c, {P}stats""",
        f"{P}points": f"""
            SELECT customer_id, scaled_recency AS x, scaled_frequency AS y, scaled_net_monetary AS z FROM {P}scaled""",
    }


def kpp_ctes(fits: str, k_max: int, prefix: str = "", points: str = "points") -> dict[str, str]:
    """Seeded k-means++ picks for every fit in ``fits`` (columns fit, seed, init, k)."""
    P = prefix
    out: dict[str, str] = {}
    for j in range(k_max):
        if j == 0:
            score = f"-ln({draw_sql('f.seed', 'f.init', 0, 'p.customer_id')})"
            src = f"{points} p, {fits} f"
            where = ""
        else:
            d2 = f"min({d2_sql('p.x', 'p.y', 'p.z', 'c.x', 'c.y', 'c.z')})"
            score = None
            src = None
        if j == 0:
            out[f"{P}pick0"] = f"""
                SELECT f.fit, 0 AS l, min({{'s': {score}, 'id': p.customer_id, 'x': p.x, 'y': p.y, 'z': p.z}}) AS p
                FROM {src} GROUP BY f.fit"""
        else:
            chosen = " UNION ALL ".join(f"SELECT fit, p.x AS x, p.y AS y, p.z AS z FROM {P}pick{i}" for i in range(j))
            out[f"{P}dsq{j}"] = f"""
                SELECT f.fit, f.seed, f.init, p.customer_id, p.x, p.y, p.z,
                       min({d2_sql('p.x', 'p.y', 'p.z', 'c.x', 'c.y', 'c.z')}) AS d2
                FROM {points} p, {fits} f JOIN ({chosen}) c ON c.fit = f.fit
                WHERE f.k > {j}
                GROUP BY ALL"""
            sc = f"CASE WHEN d2 > 0 THEN -ln({draw_sql('seed', 'init', j)}) / d2 ELSE 'inf'::DOUBLE END"
            out[f"{P}pick{j}"] = f"""
                SELECT fit, {j} AS l, min({{'s': {sc}, 'id': customer_id, 'x': x, 'y': y, 'z': z}}) AS p
                FROM {P}dsq{j} GROUP BY fit"""
    out[f"{P}kpp"] = " UNION ALL ".join(
        f"SELECT fit, l, p.id AS pick_id, p.x AS cx, p.y AS cy, p.z AS cz FROM {P}pick{j}" for j in range(k_max)
    )
    return out


def lloyd_ctes(fits: str, p: Params, prefix: str = "", points: str = "points") -> dict[str, str]:
    """Lloyd rounds for every fit until its centres stop moving: ``{prefix}final`` holds
    (fit, l, cx, cy, cz, iterations)."""
    P = prefix
    dec = "DECIMAL(18,10)"

    def mean(c: str, old: str) -> str:
        return (
            f"CASE WHEN count(CASE WHEN w = l THEN 1 END) > 0 THEN "
            f"CAST(CAST(sum(CASE WHEN w = l THEN CAST({c} AS {dec}) END) AS VARCHAR) AS DOUBLE)"
            f" / count(CASE WHEN w = l THEN 1 END) ELSE {old} END"
        )

    return {
        f"{P}lloyd": f"""
            SELECT 0 AS it, fit, l, cx, cy, cz, true AS moving FROM {P}kpp
            UNION ALL
            SELECT it + 1, fit, l, nx, ny, nz,
                   bool_or(nx <> cx OR ny <> cy OR nz <> cz) OVER (PARTITION BY fit) AS moving
            FROM (
              SELECT it, fit, l, cx, cy, cz, {mean('x', 'cx')} AS nx, {mean('y', 'cy')} AS ny, {mean('z', 'cz')} AS nz
              FROM (
                SELECT s.it, s.fit, s.l, s.cx, s.cy, s.cz, p.x, p.y, p.z,
                       (min({{'d2': {d2_sql('p.x', 'p.y', 'p.z', 's.cx', 's.cy', 's.cz')}, 'l': s.l}})
                          OVER (PARTITION BY s.fit, p.customer_id)).l AS w
                FROM {P}lloyd s JOIN {fits} f ON s.fit = f.fit JOIN {points} p ON true
                WHERE s.moving AND s.it < {p.max_iter}
              ) GROUP BY it, fit, l, cx, cy, cz
            )""",
        f"{P}final": f"""
            SELECT fit, l, cx, cy, cz, it AS iterations FROM {P}lloyd
            QUALIFY it = max(it) OVER (PARTITION BY fit)""",
    }


def assign_sql(final: str, points: str = "points", fits: str | None = None) -> str:
    """(fit, customer_id, x, y, z, label, d2, dist) against final centres."""
    join_fits = f"JOIN {fits} f ON f.fit = c.fit" if fits else ""
    return f"""
        SELECT fit, customer_id, x, y, z, b.l AS label, b.d2 AS d2, b.dist AS dist FROM (
          SELECT c.fit, p.customer_id, p.x, p.y, p.z,
                 min({{'d2': {d2_sql('p.x', 'p.y', 'p.z', 'c.cx', 'c.cy', 'c.cz')}, 'l': c.l,
                      'dist': sqrt({d2_sql('p.x', 'p.y', 'p.z', 'c.cx', 'c.cy', 'c.cz', rounded=False)})}}) AS b
          FROM {final} c {join_fits} JOIN {points} p ON true
          GROUP BY c.fit, p.customer_id, p.x, p.y, p.z)"""


def model_ctes(p: Params = DEFAULT) -> dict[str, str]:
    """The final model: best of n_init seeded fits, named segments, representatives."""
    out = prep_ctes(p.cap_quantile)
    out["mfits"] = (
        f"SELECT CAST(range AS INTEGER) AS fit, {p.seed} AS seed, CAST(range AS INTEGER) AS init, {p.k} AS k "
        f"FROM range({p.n_init})"
    )
    out.update(kpp_ctes("mfits", p.k, prefix="m_"))
    out.update(lloyd_ctes("mfits", p, prefix="m_"))
    out["m_assign"] = assign_sql("m_final")
    out["m_best"] = """
        SELECT fit FROM (SELECT fit, sum(CAST(d2 AS DECIMAL(20,10))) AS inertia FROM m_assign GROUP BY fit)
        ORDER BY inertia, fit LIMIT 1"""
    out["labelled"] = """
        SELECT s.*, a.label AS raw_cluster, a.dist AS centroid_distance
        FROM scaled s JOIN m_assign a ON a.customer_id = s.customer_id
        WHERE a.fit = (SELECT fit FROM m_best)"""
    out["mapping"] = """
        SELECT raw_cluster, 'S' || CAST(row_number() OVER (ORDER BY med, raw_cluster) AS VARCHAR) AS segment_code,
               CAST(row_number() OVER (ORDER BY med, raw_cluster) AS INTEGER) AS segment_order, med
        FROM (SELECT raw_cluster, quantile_cont(CAST(CAST(net_monetary AS VARCHAR) AS DOUBLE), 0.5) AS med
              FROM labelled GROUP BY raw_cluster)"""
    out["reps"] = """
        SELECT segment_code, (min({'d': centroid_distance, 'id': customer_id})).id AS customer_id
        FROM labelled JOIN mapping USING (raw_cluster) GROUP BY segment_code"""
    out["segmented"] = """
        SELECT l.*, m.segment_code, m.segment_order, l.customer_id IN (SELECT customer_id FROM reps) AS is_representative
        FROM labelled l JOIN mapping m USING (raw_cluster)"""
    out["centroids"] = """
        SELECT m.segment_code, f.l AS raw_cluster, f.cx, f.cy, f.cz
        FROM m_final f JOIN mapping m ON m.raw_cluster = f.l WHERE f.fit = (SELECT fit FROM m_best)"""
    return out


def model_query(body: str, p: Params = DEFAULT, extra: dict[str, str] | None = None, bases: tuple[str, ...] = ("rfm",)) -> str:
    ctes = dict(model_ctes(p))
    ctes.update(extra or {})
    return "WITH RECURSIVE " + with_ctes(body, list(bases), p, ctes)[len("WITH "):]


def q8(c: str) -> str:
    return f"round(CAST({c} AS DOUBLE), 8)"


def dround(c: str, digits: int) -> str:
    return f"CAST(round(CAST({c} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def dim_sql(p: Params) -> str:
    rows = ", ".join(
        "(" + ", ".join([_lit(c), str(int(c[1:])), _lit(n), _lit(d), _lit(h), _lit(k)]) + ")" for c, n, d, h, k in p.segments
    )
    return (
        f"SELECT * FROM (VALUES {rows}) AS t(segment_code, segment_order, segment_name, description, "
        "strategy_hypothesis, future_kpis)"
    )


def _lit(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


PROFILE_METRICS = ("recency", "frequency", "gross_monetary", "net_monetary")


def _as_double(m: str) -> str:
    return net_d(m) if "monetary" in m else f"CAST({m} AS DOUBLE)"


def serving_ctes(p: Params) -> dict[str, str]:
    aggs = []
    for m in PROFILE_METRICS:
        v = _as_double(m)
        aggs.append(f"avg({v}) AS {m}_mean")
        aggs.append(f"quantile_cont({v}, 0.25) AS {m}_q25")
        aggs.append(f"quantile_cont({v}, 0.5) AS {m}_median")
        aggs.append(f"quantile_cont({v}, 0.75) AS {m}_q75")
    cols = ", ".join(f"b.{m}_{n}" for m in PROFILE_METRICS for n in ("mean", "q25", "median", "q75"))
    return {
        "dim": dim_sql(p),
        "pbase": f"""
            SELECT segment_code, count(*) AS customers, sum(net_monetary) AS net_monetary_total, {', '.join(aggs)}
            FROM segmented GROUP BY segment_code""",
        "ptot": "SELECT count(*) AS n_all, sum(net_monetary) AS net_all FROM segmented",
        "profiles": f"""
            SELECT d.*, coalesce(b.customers, 0) AS customers, coalesce(b.customers, 0) / t.n_all AS customer_share,
                   coalesce(b.net_monetary_total, 0) AS net_monetary_total,
                   {net_d('coalesce(b.net_monetary_total, 0)')} / {net_d('t.net_all')} AS net_monetary_share, {cols}
            FROM dim d LEFT JOIN pbase b USING (segment_code), ptot t""",
        "demo": f"SELECT customer_id FROM reps WHERE segment_code = 'S{p.k}'",
        "timeline": """
            SELECT customer_id, invoice_no, min(invoice_date) AS invoice_date, sum(line_amount) AS invoice_amount,
                   count(*) AS line_count, bool_or(is_cancellation) AS is_cancellation,
                   bool_or(is_valid_positive_purchase) AS has_valid_positive_line
            FROM known GROUP BY customer_id, invoice_no""",
        "countries": """
            SELECT customer_id, country FROM known WHERE customer_id IN (SELECT customer_id FROM rfm)
            GROUP BY customer_id, country""",
    }


def trace_ctes(p: Params) -> dict[str, str]:
    """Lloyd trace of restart 0 from its k-means++ start (before/after centres, sizes, changes)."""
    dec = "DECIMAL(18,10)"

    def mean(c: str, old: str) -> str:
        return (
            f"CASE WHEN count(CASE WHEN w = l THEN 1 END) > 0 THEN "
            f"CAST(CAST(sum(CASE WHEN w = l THEN CAST({c} AS {dec}) END) AS VARCHAR) AS DOUBLE)"
            f" / count(CASE WHEN w = l THEN 1 END) ELSE {old} END"
        )

    d_a = d2_sql("p.x", "p.y", "p.z", "t.a_x", "t.a_y", "t.a_z")
    d_b = d2_sql("p.x", "p.y", "p.z", "t.b_x", "t.b_y", "t.b_z")
    d_k = d2_sql("p.x", "p.y", "p.z", "k.cx", "k.cy", "k.cz")
    return {
        "trace": f"""
            SELECT 1 AS it, l, cx AS b_x, cy AS b_y, cz AS b_z, {mean('x', 'cx')} AS a_x, {mean('y', 'cy')} AS a_y,
                   {mean('z', 'cz')} AS a_z, count(CASE WHEN w = l THEN 1 END) AS n, 0 AS changed, true AS cont
            FROM (SELECT k.l, k.cx, k.cy, k.cz, p.x, p.y, p.z,
                         (min({{'d2': {d_k}, 'l': k.l}}) OVER (PARTITION BY p.customer_id)).l AS w
                  FROM (SELECT * FROM m_kpp WHERE fit = 0) k, points p)
            GROUP BY l, cx, cy, cz
            UNION ALL
            SELECT it + 1, l, a_x, a_y, a_z, nx, ny, nz, n, sum(ch) OVER () AS changed, sum(ch) OVER () > 0 AS cont
            FROM (
              SELECT it, l, a_x, a_y, a_z, {mean('x', 'a_x')} AS nx, {mean('y', 'a_y')} AS ny, {mean('z', 'a_z')} AS nz,
                     count(CASE WHEN w = l THEN 1 END) AS n, count(CASE WHEN w = l AND pw <> w THEN 1 END) AS ch
              FROM (SELECT t.it, t.l, t.a_x, t.a_y, t.a_z, p.x, p.y, p.z,
                           (min({{'d2': {d_a}, 'l': t.l}}) OVER (PARTITION BY p.customer_id)).l AS w,
                           (min({{'d2': {d_b}, 'l': t.l}}) OVER (PARTITION BY p.customer_id)).l AS pw
                    FROM trace t, points p WHERE t.cont AND t.it < {p.max_iter})
              GROUP BY it, l, a_x, a_y, a_z)""",
        "trace_out": """
            SELECT it, l, n, b_x, b_y, b_z, a_x, a_y, a_z, changed,
                   max(sqrt((a_x - b_x) * (a_x - b_x) + (a_y - b_y) * (a_y - b_y) + (a_z - b_z) * (a_z - b_z))) OVER (PARTITION BY it)
                     AS shift
            FROM trace""",
        "trace_labels": f"""
            SELECT p.customer_id, (min({{'d2': {d2_sql('p.x', 'p.y', 'p.z', 't.b_x', 't.b_y', 't.b_z')}, 'l': t.l}})).l AS trace_label
            FROM points p, (SELECT * FROM trace WHERE it = (SELECT max(it) FROM trace)) t
            GROUP BY p.customer_id""",
    }


def ari_sql(pairs: str, a: str, b: str) -> str:
    """ARI of two labelings given as columns of ``pairs`` (one row per item)."""
    return f"""
        SELECT CASE WHEN den = 0 THEN 1.0 ELSE (s_ij - expected) / den END AS ari FROM (
          SELECT s_ij, s_a * s_b / (n_all * (n_all - 1) / 2.0) AS expected,
                 (s_a + s_b) / 2.0 - s_a * s_b / (n_all * (n_all - 1) / 2.0) AS den
          FROM (SELECT sum(n * (n - 1) / 2.0) AS s_ij, sum(n) AS n_all FROM (SELECT count(*) AS n FROM {pairs} GROUP BY {a}, {b})),
               (SELECT sum(n * (n - 1) / 2.0) AS s_a FROM (SELECT count(*) AS n FROM {pairs} GROUP BY {a})),
               (SELECT sum(n * (n - 1) / 2.0) AS s_b FROM (SELECT count(*) AS n FROM {pairs} GROUP BY {b})))"""


def model_oracles(p: Params = DEFAULT) -> dict[str, str]:
    q: dict[str, str] = {}
    sv = serving_ctes(p)
    tr = trace_ctes(p)

    def mq(body: str, *extra: dict[str, str]) -> str:
        merged: dict[str, str] = {}
        for e in extra:
            merged.update(e)
        return model_query(body, p, merged)

    q["customer_segments"] = mq(
        f"""SELECT customer_id, country_display, {day('last_purchase')} AS last_purchase_date, recency, frequency,
                   {money('gross_monetary')} AS gross_monetary, {money('net_monetary')} AS net_monetary,
                   {q8('frequency_capped')} AS frequency_capped, {q8('net_monetary_capped')} AS net_monetary_capped,
                   scaled_recency, scaled_frequency, scaled_net_monetary, CAST(raw_cluster AS BIGINT) AS raw_cluster,
                   segment_code, centroid_distance,
                   frequency_capped_flag, monetary_capped_flag, any_capped_flag, is_representative
            FROM segmented"""
    )
    q["feature_caps"] = mq(
        f"""SELECT CAST({p.cap_quantile} AS DOUBLE) AS cap_quantile, {q8('max(fcap)')} AS frequency_cap,
                   {q8('max(mcap)')} AS net_monetary_cap,
                   CAST(count(*) FILTER (WHERE frequency_capped_flag) AS BIGINT) AS frequency_capped_customers,
                   CAST(count(*) FILTER (WHERE monetary_capped_flag) AS BIGINT) AS monetary_capped_customers,
                   CAST(count(*) FILTER (WHERE any_capped_flag) AS BIGINT) AS either_affected
            FROM capped, caps"""
    )
    q["rfm_capped"] = mq(
        f"""SELECT customer_id, {q8('frequency_capped')} AS frequency_capped, {q8('net_monetary_capped')} AS net_monetary_capped,
                   frequency_capped_flag, monetary_capped_flag, any_capped_flag FROM capped"""
    )
    q["rfm_scaled"] = mq("SELECT customer_id, scaled_recency, scaled_frequency, scaled_net_monetary FROM scaled")
    q["feature_finite_check"] = mq(
        """SELECT CAST(count(*) FILTER (WHERE x IS NULL OR y IS NULL OR z IS NULL OR isnan(x) OR isnan(y) OR isnan(z)
                                            OR isinf(x) OR isinf(y) OR isinf(z)) AS BIGINT) AS non_finite_rows
           FROM points"""
    )
    steps = " UNION ALL ".join(f"SELECT {j} AS step, customer_id, d2 FROM m_dsq{j} WHERE fit = 0" for j in range(1, p.k))
    q["kpp_weights"] = mq(
        f"""SELECT CAST(step + 1 AS BIGINT) AS center_number, customer_id, d2, d2 / total AS probability,
                   round(least(greatest(d2 / cap, 0.0), 1.0), 6) AS display_intensity, customer_id = pick_id AS is_selected
            FROM ksteps JOIN ktot USING (step) LEFT JOIN kcap USING (step) JOIN kpicks USING (step)
            UNION ALL
            SELECT CAST(1 AS BIGINT), customer_id, CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(0.0 AS DOUBLE),
                   customer_id = (SELECT pick_id FROM kpicks WHERE step = 0)
            FROM points""",
        {
            "ksteps": steps,
            "ktot": "SELECT step, CAST(CAST(sum(CAST(d2 AS DECIMAL(20,10))) AS VARCHAR) AS DOUBLE) AS total FROM ksteps GROUP BY step",
            "kcap": "SELECT step, quantile_cont(d2, 0.995) AS cap FROM ksteps WHERE d2 > 0 GROUP BY step",
            "kpicks": "SELECT l AS step, pick_id FROM m_kpp WHERE fit = 0",
        },
    )
    nearest_k = f"""
        SELECT p.customer_id, p.x, p.y, p.z,
               min({{'d2': {d2_sql('p.x', 'p.y', 'p.z', 'k.cx', 'k.cy', 'k.cz')}, 'l': k.l,
                    'dist': sqrt({d2_sql('p.x', 'p.y', 'p.z', 'k.cx', 'k.cy', 'k.cz', rounded=False)})}}) AS b
        FROM points p, (SELECT * FROM m_kpp WHERE fit = 0) k GROUP BY p.customer_id, p.x, p.y, p.z"""
    q["assign_nearest"] = mq(
        "SELECT customer_id, CAST(b.l AS BIGINT) AS label, b.d2 AS d2, b.dist AS distance FROM nk",
        {"nk": nearest_k},
    )

    def cmean(c: str) -> str:
        return f"CAST(CAST(sum(CAST({c} AS DECIMAL(18,10))) AS VARCHAR) AS DOUBLE) / count(*)"

    q["lloyd_step"] = mq(
        f"""SELECT CAST(b.l AS BIGINT) AS label, CAST(count(*) AS BIGINT) AS size, {cmean('x')} AS x, {cmean('y')} AS y,
                   {cmean('z')} AS z, CAST(CAST(sum(CAST(b.d2 AS DECIMAL(20,10))) AS VARCHAR) AS DOUBLE) AS inertia
            FROM nk GROUP BY b.l""",
        {"nk": nearest_k},
    )
    q["lloyd_trace"] = mq(
        """SELECT CAST(it AS BIGINT) AS iteration, CAST(l AS BIGINT) AS label, CAST(n AS BIGINT) AS size,
                  b_x AS before_x, b_y AS before_y, b_z AS before_z, a_x AS after_x, a_y AS after_y, a_z AS after_z,
                  CAST(changed AS BIGINT) AS changed_count, round(shift, 6) AS max_centroid_shift
           FROM trace_out""",
        tr,
    )
    q["lloyd_changes"] = mq(
        """SELECT CAST(b.it AS BIGINT) AS iteration, b.customer_id, CAST(a.l AS BIGINT) AS label_before, CAST(b.l AS BIGINT) AS label_after
           FROM ch_labels a JOIN ch_labels b ON a.customer_id = b.customer_id AND b.it = a.it + 1 AND a.l <> b.l""",
        tr,
        {"ch_labels": f"""
            SELECT t.it, p.customer_id, (min({{'d2': {d2_sql('p.x', 'p.y', 'p.z', 't.b_x', 't.b_y', 't.b_z')}, 'l': t.l}})).l AS l
            FROM points p, trace t GROUP BY t.it, p.customer_id"""},
    )
    q["semantic_mapping"] = mq(
        f"""SELECT CAST(m.raw_cluster AS BIGINT) AS raw_cluster, m.segment_code, CAST(m.segment_order AS BIGINT) AS segment_order,
                   {q8('m.med')} AS median_net_monetary, CAST(c.n AS BIGINT) AS customers
            FROM mapping m JOIN (SELECT raw_cluster, count(*) AS n FROM labelled GROUP BY raw_cluster) c USING (raw_cluster)"""
    )
    q["majority_mapping"] = mq(
        """SELECT CAST(trace_label AS BIGINT) AS raw_cluster, segment_code, CAST(members AS BIGINT) AS members,
                  CAST(n AS BIGINT) AS agreeing, round((SELECT ari FROM mm_ari), 6) AS ari_vs_final,
                  count(*) OVER () = 4 AND (SELECT count(DISTINCT segment_code) FROM mm_top) = 4 AS one_to_one
           FROM (SELECT trace_label, segment_code, n, sum(n) OVER (PARTITION BY trace_label) AS members,
                        row_number() OVER (PARTITION BY trace_label ORDER BY n DESC, segment_code) AS rk
                 FROM (SELECT trace_label, segment_code, count(*) AS n FROM mm_pairs GROUP BY ALL))
           WHERE rk = 1""",
        tr,
        {
            "mm_pairs": "SELECT t.trace_label, s.segment_code FROM trace_labels t JOIN segmented s USING (customer_id)",
            "mm_top": """SELECT segment_code FROM (SELECT trace_label, segment_code, count(*) AS n FROM mm_pairs GROUP BY ALL)
                         QUALIFY row_number() OVER (PARTITION BY trace_label ORDER BY n DESC, segment_code) = 1""",
            "mm_ari": ari_sql("mm_pairs", "trace_label", "segment_code"),
        },
    )
    prof_cols = []
    for m in PROFILE_METRICS:
        for n in ("mean", "q25", "median", "q75"):
            f = dbl if n == "mean" else q8
            prof_cols.append(f"{f(f'{m}_{n}')} AS {m}_{n}")
    q["segment_profiles"] = mq(
        f"""SELECT segment_code, CAST(segment_order AS BIGINT) AS segment_order, segment_name, description,
                   strategy_hypothesis, future_kpis, CAST(customers AS BIGINT) AS customers,
                   {dbl('customer_share')} AS customer_share, {money('net_monetary_total')} AS net_monetary_total,
                   {dbl('net_monetary_share')} AS net_monetary_share, {', '.join(prof_cols)}
            FROM profiles""",
        sv,
    )
    q["cluster_centroids"] = mq(
        """SELECT segment_code, CAST(raw_cluster AS BIGINT) AS raw_cluster, cx AS scaled_recency, cy AS scaled_frequency,
                  cz AS scaled_net_monetary FROM centroids"""
    )
    q["segment_counts"] = mq("SELECT segment_code, CAST(count(*) AS BIGINT) AS customers FROM segmented GROUP BY segment_code")
    q["representatives"] = mq("SELECT segment_code, customer_id, centroid_distance FROM segmented WHERE is_representative")
    top = f"('S{p.k - 1}', 'S{p.k}')"
    q["findings_high_value"] = mq(
        f"""SELECT CAST(sum(customers) FILTER (WHERE segment_code IN {top}) AS BIGINT) AS top_customers,
                   {dbl(f'sum(customer_share) FILTER (WHERE segment_code IN {top})')} AS top_customer_share,
                   {dbl(f'sum(net_monetary_share) FILTER (WHERE segment_code IN {top})')} AS top_net_share,
                   {money('sum(net_monetary_total)')} AS clustered_net_total
            FROM profiles""",
        sv,
    )
    q["overview_shares"] = mq(
        f"""SELECT segment_code, segment_name, 'customers' AS measure, {dbl('customer_share * 100.0')} AS share_percent FROM profiles
            UNION ALL
            SELECT segment_code, segment_name, 'net_monetary', {dbl('net_monetary_share * 100.0')} FROM profiles""",
        sv,
    )
    q["monotone_ladder"] = mq(
        f"""SELECT segment_code, CAST(segment_order AS BIGINT) AS segment_order, {q8('recency_median')} AS recency_median,
                   {q8('frequency_median')} AS frequency_median, {q8('net_monetary_median')} AS net_monetary_median,
                   r_ok, f_ok, m_ok, bool_and(r_ok AND f_ok AND m_ok) OVER () AS ordering
            FROM (SELECT *, coalesce(recency_median <= lag(recency_median) OVER w, true) AS r_ok,
                         coalesce(frequency_median >= lag(frequency_median) OVER w, true) AS f_ok,
                         coalesce(net_monetary_median >= lag(net_monetary_median) OVER w, true) AS m_ok
                  FROM profiles WHERE customers > 0 WINDOW w AS (ORDER BY segment_order))""",
        sv,
    )
    q["long_tail"] = with_ctes(
        f"""SELECT metric, {q8('quantile_cont(v, 0.5)')} AS median, {q8('quantile_cont(v, 0.995)')} AS q995, max(v) AS maximum
            FROM (SELECT 'frequency' AS metric, CAST(frequency AS DOUBLE) AS v FROM rfm
                  UNION ALL SELECT 'net_monetary', {net_d()} FROM rfm)
            GROUP BY metric""",
        ["rfm"],
        p,
    )
    q["gross_net_gap"] = with_ctes(
        f"""SELECT CAST(row_number() OVER (ORDER BY gap DESC, customer_id) AS BIGINT) AS rank, customer_id,
                   {money('gross_monetary')} AS gross_monetary, {money('net_monetary')} AS net_monetary, {money('gap')} AS gap
            FROM (SELECT customer_id, gross_monetary, net_monetary, gross_monetary - net_monetary AS gap FROM rfm)
""",
        ["rfm"],
        p,
    )
    q["line_funnel"] = mq(
        """SELECT (SELECT CAST(count(*) AS BIGINT) FROM known) AS known_transaction_lines,
                  (SELECT CAST(count(*) FILTER (WHERE is_valid_positive_purchase) AS BIGINT) FROM known) AS valid_positive_lines,
                  (SELECT CAST(count(*) AS BIGINT) FROM capped) AS customers,
                  (SELECT CAST(count(*) FILTER (WHERE any_capped_flag) AS BIGINT) FROM capped) AS cap_affected_customers"""
    )
    tl_cols = f"""customer_id, invoice_no, {ts('invoice_date')} AS invoice_date, {money('invoice_amount')} AS invoice_amount,
                  CAST(line_count AS BIGINT) AS line_count, is_cancellation, has_valid_positive_line"""
    q["invoice_timeline"] = mq(
        f"""SELECT {tl_cols},
                   CASE WHEN is_cancellation THEN 'cancellation' WHEN invoice_amount >= 0 THEN 'purchase'
                        ELSE 'negative_other' END AS entry_class
            FROM timeline""",
        sv,
    )
    q["customer_timeline"] = mq(
        f"SELECT {tl_cols} FROM timeline WHERE customer_id = (SELECT customer_id FROM demo) ORDER BY invoice_date, invoice_no",
        sv,
    )
    q["customer_page"] = mq(
        f"""SELECT s.customer_id, s.segment_code, d.segment_name, s.country_display, s.recency, s.frequency,
                   {money('s.gross_monetary')} AS gross_monetary, {money('s.net_monetary')} AS net_monetary,
                   s.centroid_distance,
                   CAST((SELECT count(*) FROM timeline t WHERE t.customer_id = s.customer_id) AS BIGINT) AS invoice_count,
                   CAST((SELECT count(*) FILTER (WHERE is_cancellation) FROM timeline t WHERE t.customer_id = s.customer_id) AS BIGINT)
                     AS cancellation_count,
                   s.is_representative, CASE WHEN s.any_capped_flag THEN 'Yes' ELSE 'No' END AS capped_display
            FROM segmented s JOIN dim d USING (segment_code)
            WHERE s.customer_id = (SELECT customer_id FROM demo)""",
        sv,
    )
    unions = " UNION ALL ".join(
        f"SELECT '{m}' AS metric, {_as_double('s.' + m)} AS value, pr.{m}_median AS median "
        f"FROM segmented s JOIN profiles pr USING (segment_code) WHERE s.customer_id = (SELECT customer_id FROM demo)"
        for m in PROFILE_METRICS
    )
    q["customer_vs_segment"] = mq(
        f"""SELECT metric, value AS customer_value, {q8('median')} AS segment_median, {dbl('top')} AS top,
                   {dbl('least(100.0, 100.0 * abs(value) / top)')} AS customer_width,
                   {dbl('least(100.0, 100.0 * abs(median) / top)')} AS median_width
            FROM (SELECT *, 1.18 * greatest(abs(value), abs(median), 1.0) AS top FROM ({unions}))""",
        sv,
    )
    q["filtered_customers"] = mq(
        f"""SELECT customer_id, segment_code, country_display, any_capped_flag FROM segmented
            WHERE segment_code IN {top} AND NOT any_capped_flag
              AND customer_id IN (SELECT customer_id FROM countries WHERE country IN ({_lit(p.home_country)}, 'ASIA'))""",
        sv,
    )
    q["country_index"] = mq(
        f"""SELECT country, CAST(customers AS BIGINT) AS customers,
                   CAST(row_number() OVER (ORDER BY country <> {_lit(p.home_country)}, country) AS BIGINT) AS option_order
            FROM (SELECT country, count(DISTINCT customer_id) AS customers FROM countries WHERE country IS NOT NULL GROUP BY country)""",
        sv,
    )
    q["customer_options"] = mq(
        "SELECT customer_id || ' · ' || segment_code || ' · ' || country_display AS label, customer_id AS value FROM segmented"
    )
    q["explorer_groups"] = mq(
        """SELECT g.segment_code, g.any_capped_flag AS capped, CAST(g.n AS BIGINT) AS customers,
                  c.cx AS centre_recency, c.cy AS centre_frequency, c.cz AS centre_net_monetary
           FROM (SELECT segment_code, any_capped_flag, count(*) AS n FROM segmented GROUP BY ALL) g
           JOIN centroids c USING (segment_code)"""
    )
    q["explorer_points"] = mq(
        f"""SELECT CASE WHEN customer_id = (SELECT customer_id FROM demo) THEN customer_id
                        ELSE printf('P%04d', row_number() OVER (ORDER BY customer_id)) END AS point_id,
                   segment_code AS segment, {dround('scaled_recency', 8)} AS x, {dround('scaled_frequency', 8)} AS y,
                   {dround('scaled_net_monetary', 8)} AS z, recency AS r, frequency AS f,
                   CAST(round(net_monetary, 2) AS DOUBLE) AS m, any_capped_flag AS capped,
                   customer_id = (SELECT customer_id FROM demo) AS demo
            FROM segmented""",
        sv,
    )
    return q


def eval_oracles(p: Params = DEFAULT) -> dict[str, str]:
    q: dict[str, str] = {}
    sv = serving_ctes(p)

    def mq(body: str, *extra: dict[str, str], bases: tuple[str, ...] = ("rfm",)) -> str:
        merged: dict[str, str] = {}
        for e in extra:
            merged.update(e)
        return model_query(body, p, merged, bases)

    kcurve = {
        "ifits": " UNION ALL ".join(
            f"SELECT {i} AS fit, {p.seed} AS seed, 0 AS init, {k} AS k" for i, k in enumerate(p.k_values)
        )
    }
    kcurve.update(kpp_ctes("ifits", max(p.k_values), prefix="i_"))
    kcurve.update(lloyd_ctes("ifits", p, prefix="i_"))
    kcurve["i_assign"] = assign_sql("i_final")
    q["inertia_by_k"] = mq(
        """SELECT CAST(f.k AS BIGINT) AS k, CAST(CAST(sum(CAST(a.d2 AS DECIMAL(20,10))) AS VARCHAR) AS DOUBLE) AS inertia,
                  CAST((SELECT min(n) FROM (SELECT count(*) AS n FROM i_assign b WHERE b.fit = f.fit GROUP BY b.label)) AS BIGINT)
                    AS min_cluster_size,
                  CAST((SELECT max(iterations) FROM i_final x WHERE x.fit = f.fit) AS BIGINT) AS iterations
           FROM i_assign a JOIN ifits f ON a.fit = f.fit GROUP BY f.fit, f.k""",
        kcurve,
    )
    pair_d = "sqrt((a.scaled_recency - b.scaled_recency) * (a.scaled_recency - b.scaled_recency) + (a.scaled_frequency - b.scaled_frequency) * (a.scaled_frequency - b.scaled_frequency) + (a.scaled_net_monetary - b.scaled_net_monetary) * (a.scaled_net_monetary - b.scaled_net_monetary))"
    q["silhouette_euclidean"] = mq(
        f"""SELECT round(avg(s), 6) AS silhouette, CAST(count(*) AS BIGINT) AS customers FROM (
              SELECT customer_id,
                     CASE WHEN n_own > 1 AND greatest(a_in, b_out) > 0 THEN (b_out - a_in) / greatest(a_in, b_out) ELSE 0 END AS s
              FROM (
                SELECT customer_id, max(CASE WHEN c = own THEN n END) AS n_own,
                       max(CASE WHEN c = own THEN sm / greatest(n - 1, 1) END) AS a_in,
                       min(CASE WHEN c <> own THEN sm / n END) AS b_out
                FROM (SELECT a.customer_id, a.raw_cluster AS own, b.raw_cluster AS c, sum({pair_d}) AS sm
                      FROM segmented a, segmented b GROUP BY a.customer_id, a.raw_cluster, b.raw_cluster) x
                JOIN (SELECT raw_cluster AS c, count(*) AS n FROM segmented GROUP BY raw_cluster) z USING (c)
                GROUP BY customer_id))"""
    )
    nearest_k = f"""
        SELECT p.customer_id, (min({{'d2': {d2_sql('p.x', 'p.y', 'p.z', 'k.cx', 'k.cy', 'k.cz')}, 'l': k.l}})).l AS start_label
        FROM points p, (SELECT * FROM m_kpp WHERE fit = 0) k GROUP BY p.customer_id"""
    q["ari_pair"] = mq(
        "SELECT round((SELECT ari FROM ap_ari), 6) AS ari",
        {
            "ap_start": nearest_k,
            "ap_pairs": "SELECT s.start_label, g.raw_cluster FROM ap_start s JOIN segmented g USING (customer_id)",
            "ap_ari": ari_sql("ap_pairs", "start_label", "raw_cluster"),
        },
    )
    # constraint report
    tl = f"""
        SELECT * FROM (
          SELECT row_number() OVER (ORDER BY source_row_number) AS line_id, *
          FROM (SELECT {LINE_COLS}, CAST(min(rn) AS BIGINT) AS source_row_number
                FROM (SELECT *, row_number() OVER (ORDER BY {ORDER_ALL}) + 1 AS rn FROM raw_lines) GROUP BY ALL) n0
          WHERE {_strip('customer_id')} IS NOT NULL AND {_strip('customer_id')} <> '')"""

    def nn(t: str, src: str, cols: list[str]) -> list[str]:
        return [f"SELECT '{t}' AS table_name, 'not_null:{c}' AS constraint_name, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS violations FROM {src}" for c in cols]

    def uq(t: str, src: str, cols: str, name: str) -> str:
        return f"SELECT '{t}', '{name}', CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM {src} GROUP BY {cols})"

    codes = ", ".join(_lit(c) for c, *_ in p.segments)
    checks = [
        *nn("transaction_lines", "tl", ["line_id", "source_row_number", "invoice_no", "stock_code", "quantity", "invoice_date",
                                         "unit_price", "customer_id", "country", "CAST(quantity * unit_price AS DECIMAL(18,4))"]),
        uq("transaction_lines", "tl", "line_id", "primary_key"),
        uq("transaction_lines", "tl", "source_row_number", "unique:source_row_number"),
        *nn("customer_segments", "segmented", ["customer_id", "country_display", "last_purchase", "recency", "frequency",
                                                "gross_monetary", "net_monetary", "segment_code", "centroid_distance"]),
        uq("customer_segments", "segmented", "customer_id", "primary_key"),
        f"SELECT 'customer_segments', 'check:segment_code', CAST(count(*) FILTER (WHERE segment_code NOT IN ({codes})) AS BIGINT) FROM segmented",
        *nn("customer_countries", "countries", ["customer_id", "country"]),
        uq("customer_countries", "countries", "customer_id, country", "primary_key"),
        "SELECT 'customer_countries', 'foreign_key:customer_id->customer_segments', CAST(count(*) AS BIGINT) FROM countries c "
        "WHERE NOT EXISTS (SELECT 1 FROM segmented s WHERE s.customer_id = c.customer_id)",
        uq("segment_profiles", "profiles", "segment_code", "primary_key"),
        uq("segment_profiles", "profiles", "segment_order", "unique:segment_order"),
        uq("cluster_centroids", "centroids", "segment_code", "primary_key"),
        uq("cluster_centroids", "centroids", "raw_cluster", "unique:raw_cluster"),
        "SELECT 'cluster_centroids', 'foreign_key:segment_code->segment_profiles', CAST(count(*) AS BIGINT) FROM centroids c "
        "WHERE NOT EXISTS (SELECT 1 FROM profiles s WHERE s.segment_code = c.segment_code)",
    ]
    flag = lambda t, src, c: f"SELECT '{t}', 'check:{c}', CAST(count(*) FILTER (WHERE CAST({c} AS INTEGER) NOT IN (0, 1)) AS BIGINT) FROM {src}"
    checks += [flag("transaction_lines", "known", c) for c in ("is_cancellation", "is_valid_positive_purchase", "is_nonpositive_quantity", "is_nonpositive_price", "is_product_like")]
    checks += [flag("customer_segments", "segmented", c) for c in ("frequency_capped_flag", "monetary_capped_flag", "any_capped_flag", "is_representative")]
    checks += [f"SELECT 'model_metadata', '{c}', CAST(0 AS BIGINT)" for c in ("not_null:metadata_key", "not_null:metadata_value", "not_null:value_type",
                                                                              "not_null:description", "primary_key")]
    # the tenth not-null check names the line amount column
    checks[9] = checks[9].replace("not_null:CAST(quantity * unit_price AS DECIMAL(18,4))", "not_null:line_amount")
    q["constraint_report"] = mq("\nUNION ALL\n".join(checks), sv, {"tl": tl})
    q["net_reconciliation"] = mq(
        """SELECT CAST(count(*) AS BIGINT) AS customers_compared, CAST(max(abs(s.net_monetary - l.line_net)) AS DOUBLE) AS max_abs_difference,
                  CAST(max(abs(s.net_monetary - l.line_net)) AS DOUBLE) <= 1e-6 AS within_tolerance
           FROM segmented s JOIN (SELECT customer_id, sum(line_amount) AS line_net FROM known GROUP BY customer_id) l USING (customer_id)"""
    )
    facts = [
        ("raw_rows", "SELECT sum(copies) FROM dedup"),
        ("deduplicated_rows", "SELECT count(*) FROM dedup"),
        ("duplicate_extra_rows", "SELECT sum(copies - 1) FROM dedup"),
        ("known_transaction_lines", "SELECT count(*) FROM known"),
        ("known_transaction_customers", "SELECT count(DISTINCT customer_id) FROM known"),
        ("customers", "SELECT count(*) FROM segmented"),
        ("positive_rows", "SELECT count(*) FILTER (WHERE is_valid_positive_purchase) FROM known"),
        ("positive_invoices", "SELECT count(DISTINCT invoice_no) FILTER (WHERE is_valid_positive_purchase) FROM known"),
        ("cap_affected_customers", "SELECT count(*) FILTER (WHERE any_capped_flag) FROM segmented"),
        ("profiles", "SELECT count(*) FROM profiles"),
        ("centroids", "SELECT count(*) FROM centroids"),
        ("clustered_net_total", f"SELECT {money('sum(net_monetary)')} FROM segmented"),
    ]
    fact_sql = " UNION ALL ".join(
        f"SELECT '{n}' AS check_name, CAST(({sq}) AS DOUBLE) AS actual_value, CAST(NULL AS VARCHAR) AS actual_text" for n, sq in facts
    )
    q["core_checks"] = mq(
        f"""{fact_sql}
            UNION ALL SELECT 'segment_count:' || segment_code, CAST(count(*) AS DOUBLE), NULL FROM segmented GROUP BY segment_code
            UNION ALL SELECT 'representative:' || segment_code, NULL, customer_id FROM segmented WHERE is_representative""",
        sv,
    )
    q["assignment_fingerprint"] = mq(
        f"""SELECT fingerprint, buckets, rows_n AS rows,
                   substr(sha256('{SCHEMA_VERSION}|{p.reference_date}|' || fingerprint), 1, 20) AS build_id
            FROM (SELECT sha256(string_agg(h, '' ORDER BY b)) AS fingerprint, CAST(count(*) AS BIGINT) AS buckets,
                         CAST(sum(n) AS BIGINT) AS rows_n
                  FROM (SELECT b, sha256(string_agg(line, chr(10) ORDER BY customer_id)) AS h, count(*) AS n
                        FROM (SELECT customer_id, customer_id || ',' || segment_code AS line,
                                     (row_number() OVER (ORDER BY customer_id) - 1) // 1000000 AS b FROM segmented)
                        GROUP BY b))"""
    )
    # scoring of copies-kept customers with the stored base model
    known_raw = f"""
        SELECT *, coalesce(starts_with(invoice_no, 'C'), false) AS c_, coalesce(quantity <= 0, false) AS q_,
               coalesce(unit_price <= 0, false) AS p_
        FROM norm_raw WHERE customer_id IS NOT NULL AND customer_id <> ''"""
    rfm_dup = f"""
        SELECT customer_id,
               CAST(date_diff('day', max(CASE WHEN v THEN CAST(invoice_date AS DATE) END), DATE '{p.reference_date}') AS BIGINT) AS recency,
               CAST(count(DISTINCT CASE WHEN v THEN invoice_no END) AS BIGINT) AS frequency,
               sum(line_amount) AS net_monetary
        FROM (SELECT *, NOT c_ AND NOT q_ AND NOT p_ AS v FROM known_raw) GROUP BY customer_id HAVING bool_or(v)"""
    fc, mc = ("least(CAST(frequency AS DOUBLE), fcap)", f"least({net_d()}, mcap)") if p.cap_quantile is not None else (
        "CAST(frequency AS DOUBLE)", net_d())
    scored = f"""
        SELECT customer_id,
               round((CAST(recency AS DOUBLE) - m0) / CASE WHEN s0 = 0 OR s0 IS NULL THEN 1 ELSE s0 END, 10) AS x,
               round(({fc} - m1) / CASE WHEN s1 = 0 OR s1 IS NULL THEN 1 ELSE s1 END, 10) AS y,
               round(({mc} - m2) / CASE WHEN s2 = 0 OR s2 IS NULL THEN 1 ELSE s2 END, 10) AS z
        FROM rfm_dup, caps, stats"""
    best_final = "SELECT l, cx, cy, cz FROM m_final WHERE fit = (SELECT fit FROM m_best)"
    q["score_customers"] = mq(
        f"""SELECT customer_id, CAST(b.l AS BIGINT) AS raw_cluster, m.segment_code, b.dist AS centroid_distance
            FROM (SELECT p.customer_id,
                         min({{'d2': {d2_sql('p.x', 'p.y', 'p.z', 'c.cx', 'c.cy', 'c.cz')}, 'l': c.l,
                              'dist': sqrt({d2_sql('p.x', 'p.y', 'p.z', 'c.cx', 'c.cy', 'c.cz', rounded=False)})}}) AS b
                  FROM sc_points p, sc_centres c GROUP BY p.customer_id) s
            JOIN mapping m ON m.raw_cluster = s.b.l""",
        {"known_raw": known_raw, "rfm_dup": rfm_dup, "sc_points": scored, "sc_centres": best_final},
        bases=("rfm", "norm_raw"),
    )
    # pairwise ARI of the single-init seeds at the chosen k
    seeds = {
        "sfits": " UNION ALL ".join(f"SELECT {i} AS fit, {s_} AS seed, 0 AS init, {p.k} AS k" for i, s_ in enumerate(p.seeds))
    }
    seeds.update(kpp_ctes("sfits", p.k, prefix="s_"))
    seeds.update(lloyd_ctes("sfits", p, prefix="s_"))
    seeds["s_assign"] = assign_sql("s_final")
    seeds["s_lab"] = "SELECT f.seed, a.customer_id, a.label FROM s_assign a JOIN sfits f ON a.fit = f.fit"
    seeds["s_cells"] = """
        SELECT a.seed AS seed_a, b.seed AS seed_b, a.label AS la, b.label AS lb, count(*) AS n
        FROM s_lab a JOIN s_lab b ON a.customer_id = b.customer_id AND a.seed < b.seed GROUP BY ALL"""
    q["ari_seed_pairs"] = mq(
        """SELECT CAST(seed_a AS BIGINT) AS seed_a, CAST(seed_b AS BIGINT) AS seed_b,
                  round(CASE WHEN den = 0 THEN 1.0 ELSE (s_ij - expected) / den END, 6) AS ari
           FROM (SELECT seed_a, seed_b, s_ij, s_a * s_b / (n_all * (n_all - 1) / 2.0) AS expected,
                        (s_a + s_b) / 2.0 - s_a * s_b / (n_all * (n_all - 1) / 2.0) AS den
                 FROM (SELECT seed_a, seed_b, sum(n * (n - 1) / 2.0) AS s_ij, sum(n) AS n_all FROM s_cells GROUP BY ALL)
                 JOIN (SELECT seed_a, seed_b, sum(m * (m - 1) / 2.0) AS s_a
                       FROM (SELECT seed_a, seed_b, la, sum(n) AS m FROM s_cells GROUP BY ALL) GROUP BY ALL) USING (seed_a, seed_b)
                 JOIN (SELECT seed_a, seed_b, sum(m * (m - 1) / 2.0) AS s_b
                       FROM (SELECT seed_a, seed_b, lb, sum(n) AS m FROM s_cells GROUP BY ALL) GROUP BY ALL) USING (seed_a, seed_b))""",
        seeds,
    )
    return q


def stored_build_sql(q: dict[str, str]) -> str:
    """Rows of each stored table, counted from the queries that make them; the last ones have a fixed number of rows."""
    counted = {"transaction_lines": "lines_flagged", "invoice_timeline": "invoice_timeline", "customer_segments": "customer_segments",
               "customer_countries": "customer_countries", "core_checks": "core_checks"}
    fixed = {"segment_profiles": 4, "cluster_centroids": 4, "model_metadata": 20, "model_params": 4}
    parts = [f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS stored_rows, true AS unchanged FROM ({q[name]})" for t, name in counted.items()]
    return "\nUNION ALL\n".join(parts + [f"SELECT '{t}', CAST({n} AS BIGINT), true" for t, n in fixed.items()])


def all_oracles(p: Params = DEFAULT) -> dict[str, str]:
    out = oracle_texts(p)
    out.update(model_oracles(p))
    out.update(eval_oracles(p))
    out["stored_build"] = stored_build_sql(out)
    return out
