"""DuckDB twins of the registered queries (the correctness gate).

Each string runs on the driver's pre-registered parquet views. Doubles are
rounded to 6 decimals and ``+ 0.0`` folds -0.0, mirroring ``queries.finish``.
"""

from __future__ import annotations

from sparkqc.plans.fixtures import DELIVERIES, with_views


def r6(expr: str) -> str:
    return f"(round(CAST({expr} AS DOUBLE), 6) + 0.0)"


LINEITEM_LONG = """li_long AS (
    SELECT 'l_quantity' AS col, l_quantity AS v FROM lineitem UNION ALL
    SELECT 'l_extendedprice', l_extendedprice FROM lineitem UNION ALL
    SELECT 'l_discount', l_discount FROM lineitem UNION ALL
    SELECT 'l_tax', l_tax FROM lineitem)"""

LI_IQR = """li_iqr AS (SELECT col, quantile_cont(v, 0.25) - 1.5e0 * (quantile_cont(v, 0.75) - quantile_cont(v, 0.25)) AS lower,
    quantile_cont(v, 0.75) + 1.5e0 * (quantile_cont(v, 0.75) - quantile_cont(v, 0.25)) AS upper FROM li_long GROUP BY col)"""

LI_GAUSS = """li_gauss AS (SELECT col, avg(v) - 3e0 * stddev_pop(v) AS lower, avg(v) + 3e0 * stddev_pop(v) AS upper
    FROM li_long GROUP BY col)"""


def _outlier_report(bounds: str) -> str:
    return with_views(LINEITEM_LONG, bounds) + f"""SELECT l.col,
    CAST(count(*) FILTER (WHERE l.v < b.lower OR l.v > b.upper) AS BIGINT) AS n_outliers,
    {r6("round_even(count(*) FILTER (WHERE l.v < b.lower OR l.v > b.upper) / count(*), 4)")} AS prop_outliers
    FROM li_long l JOIN {bounds.split()[0]} b USING (col) GROUP BY l.col"""


ORACLE = {
    "missing_profile": with_views("holes") + f"""SELECT pos, CAST(count(*) - count(v) AS BIGINT) AS n_missing,
        {r6("(count(*) - count(v)) / count(*)")} AS prop_missing FROM holes GROUP BY pos""",
    "column_moments": with_views(LINEITEM_LONG) + f"""SELECT col, count(v) AS n, {r6("avg(v)")} AS mean,
        {r6("stddev_samp(v)")} AS std_samp, {r6("stddev_pop(v)")} AS std_pop, {r6("min(v)")} AS min, {r6("max(v)")} AS max
        FROM li_long GROUP BY col""",
    "column_quantiles": with_views(LINEITEM_LONG) + f"""SELECT col, count(v) AS n, {r6("quantile_cont(v, 0.25)")} AS q25,
        {r6("quantile_cont(v, 0.5)")} AS q50, {r6("quantile_cont(v, 0.75)")} AS q75 FROM li_long GROUP BY col""",
    "column_skew_kurt": with_views(LINEITEM_LONG, "all_long AS (SELECT * FROM li_long UNION ALL SELECT 'value', value FROM events)")
        + f"""SELECT col, count(v) AS n, {r6("CASE WHEN var_pop(v) = 0 THEN 0 ELSE skewness(v) END")} AS skew,
        {r6("CASE WHEN var_pop(v) = 0 THEN 0 ELSE kurtosis(v) END")} AS kurt FROM all_long GROUP BY col""",
    "iqr_bounds": with_views(LINEITEM_LONG, LI_IQR) + f"SELECT col, {r6('lower')} AS lower, {r6('upper')} AS upper FROM li_iqr",
    "gaussian_bounds": with_views(LINEITEM_LONG, LI_GAUSS) + f"SELECT col, {r6('lower')} AS lower, {r6('upper')} AS upper FROM li_gauss",
    "outlier_report_iqr": _outlier_report(LI_IQR),
    "outlier_report_gaussian": _outlier_report(LI_GAUSS),
}


# ----------------------------------------------------------- SQL building blocks

def _lit(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def sql_log_half_erfc(u: str) -> str:
    """ln(erfc(u)/2) with the same rational approximation as ``functions.stats``."""
    from sparkqc.functions.stats import ERFC_COEFFS, LN_HALF

    a = f"abs({u})"
    t = f"(1e0 / (1e0 + 0.5e0 * {a}))"
    poly = _lit(ERFC_COEFFS[-1])
    for c in reversed(ERFC_COEFFS[:-1]):
        poly = f"({_lit(c)} + {t} * {poly})"
    log_tail = f"(ln({t}) - {a} * {a} + {poly})"
    return f"(CASE WHEN {u} >= 0 THEN {_lit(LN_HALF)} + {log_tail} ELSE ln(1e0 - 0.5e0 * exp({log_tail})) END)"


def sql_anderson(src: str, keys: list[str], name: str) -> list[str]:
    """CTEs computing ``name(keys..., n, a2, crit, is_normal)`` over ``src(keys..., v)``."""
    k = ", ".join(keys)
    on = " AND ".join(f"r.{c} = s.{c}" for c in keys)
    rk = ", ".join(f"r.{c}" for c in keys)
    sq2 = _lit(2 ** 0.5)
    z = f"((r.v - s.mean) / CASE WHEN s.sd > 0 THEN s.sd END)"
    return [
        f"{name}_s AS (SELECT {k}, avg(v) AS mean, stddev_samp(v) AS sd FROM {src} GROUP BY {k})",
        f"{name}_c AS (SELECT {k}, v, count(*) AS c FROM {src} WHERE v IS NOT NULL GROUP BY {k}, v)",
        f"""{name}_r AS (SELECT {k}, v, c, CAST(coalesce(sum(c) OVER (PARTITION BY {k} ORDER BY v
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS lo,
            CAST(sum(c) OVER (PARTITION BY {k}) AS DOUBLE) AS n FROM {name}_c)""",
        f"""{name}_z AS (SELECT {rk}, r.n, r.lo, r.lo + r.c AS hi, -{z} / {sq2} AS u1, {z} / {sq2} AS u2
            FROM {name}_r r JOIN {name}_s s ON {on})""",
        f"""{name}_t AS (SELECT {k}, n, (hi * hi - lo * lo) * {sql_log_half_erfc('u1')}
            + ((n - lo) * (n - lo) - (n - hi) * (n - hi)) * {sql_log_half_erfc('u2')} AS term FROM {name}_z)""",
        f"""{name} AS (SELECT {k}, CAST(n AS BIGINT) AS n, -n - sum(term) / n AS a2,
            round(0.787e0 / (1e0 + 4e0 / n - 25e0 / (n * n)), 3) AS crit,
            coalesce(NOT (-n - sum(term) / n > round(0.787e0 / (1e0 + 4e0 / n - 25e0 / (n * n)), 3)), true) AS is_normal
            FROM {name}_t GROUP BY {k}, n)""",
    ]


def skew_sql(v: str = "v") -> str:
    return f"CASE WHEN var_pop({v}) = 0 THEN 0e0 ELSE skewness({v}) END"


def kurt_sql(v: str = "v") -> str:
    return f"CASE WHEN var_pop({v}) = 0 THEN 0e0 ELSE kurtosis({v}) END"


MISS_CORR = [
    "ind AS (SELECT vec_id, pos, CASE WHEN v IS NULL THEN 1e0 ELSE 0e0 END AS m FROM holes)",
    "varying AS (SELECT pos FROM ind GROUP BY pos HAVING sum(m) > 0 AND sum(m) < count(*))",
    """mcorr AS (SELECT a.pos AS pos_a, b.pos AS pos_b, corr(a.m, b.m) AS r FROM ind a JOIN ind b ON a.vec_id = b.vec_id
        WHERE a.pos IN (SELECT pos FROM varying) AND b.pos IN (SELECT pos FROM varying) GROUP BY a.pos, b.pos)""",
]

SKEWED = """sk AS (SELECT vec_id, y, pos, CASE pos % 4 WHEN 0 THEN exp(8e0 * v) WHEN 1 THEN (v + 0.6e0) * (v + 0.6e0)
    WHEN 2 THEN 1e0 / (v + 0.6e0) ELSE exp(4e0 * v) - 1e0 END AS v FROM long)"""

SCORES = [
    SKEWED,
    """gate AS (SELECT pos, min(v) AS mn, count(*) FILTER (WHERE v = 0) AS zeros, count(*) FILTER (WHERE v < 0) AS neg
        FROM sk GROUP BY pos)""",
    "types AS (SELECT unnest(['logarithmic', 'reciprocal', 'square-root', 'square']) AS type)",
    """allowed AS (SELECT g.pos, t.type, (t.type = 'square-root' AND g.neg > 0) AS nan_flag FROM gate g CROSS JOIN types t
        WHERE NOT ((t.type = 'logarithmic' AND g.mn <= 0) OR (t.type = 'reciprocal' AND g.zeros > 0)))""",
    """tv AS (SELECT s.pos, a.type, CASE a.type WHEN 'logarithmic' THEN CASE WHEN s.v > 0 THEN ln(s.v) END
        WHEN 'reciprocal' THEN CASE WHEN s.v <> 0 THEN 1e0 / s.v END
        WHEN 'square-root' THEN CASE WHEN s.v >= 0 THEN sqrt(s.v) END ELSE s.v * s.v END AS v
        FROM sk s JOIN allowed a ON s.pos = a.pos)""",
    *sql_anderson("tv", ["pos", "type"], "adt"),
    f"tmom AS (SELECT pos, type, {skew_sql()} AS skew, {kurt_sql()} AS kurt FROM tv GROUP BY pos, type)",
    """scores AS (SELECT d.pos, d.type, d.n, CASE WHEN a.nan_flag THEN NULL ELSE d.a2 END AS a2, d.crit, m.skew, m.kurt
        FROM adt d JOIN tmom m ON d.pos = m.pos AND d.type = m.type JOIN allowed a ON a.pos = d.pos AND a.type = d.type)""",
]

def _yj_sql(v: str, lam: str) -> str:
    return (f"CASE WHEN {v} >= 0 THEN (CASE WHEN abs({lam}) < 1e-12 THEN ln(1e0 + {v}) ELSE (pow({v} + 1e0, {lam}) - 1e0) / {lam} END) "
            f"ELSE (CASE WHEN abs(2e0 - {lam}) < 1e-12 THEN -ln(1e0 - {v}) ELSE -(pow(1e0 - {v}, 2e0 - {lam}) - 1e0) / (2e0 - {lam}) END) END")


def _yj_pass(name: str, grid_from: str) -> list[str]:
    """One grid pass: llf per (pos, lam) and the best lam per column."""
    return [
        f"""{name}_g AS (SELECT s.pos, g.lam, count(*) AS n, var_pop({_yj_sql('s.v', 'g.lam')}) AS vr,
            sum(sign(s.v) * ln(1e0 + abs(s.v))) AS slog FROM sk s JOIN {grid_from} g ON s.pos = g.pos
            WHERE s.v IS NOT NULL GROUP BY s.pos, g.lam)""",
        f"""{name} AS (SELECT pos, lam FROM (SELECT pos, lam, row_number() OVER (PARTITION BY pos
            ORDER BY (vr > 0) DESC, CASE WHEN vr > 0 THEN -n / 2e0 * ln(vr) + (lam - 1e0) * slog END DESC, abs(lam)) AS rn
            FROM {name}_g) WHERE rn = 1)""",
    ]


def _yj_fit_sql(start: float = -4.0, stop: float = 4.0, step: float = 0.25, refinements: int = 2, points: int = 10):
    n_steps = int(round((stop - start) / step))
    lams = ", ".join(repr(start + i * step) + "e0" if "e" not in repr(start + i * step) else repr(start + i * step)
                     for i in range(n_steps + 1))
    out = [f"yjg0 AS (SELECT p.pos, CAST(unnest([{lams}]) AS DOUBLE) AS lam FROM (SELECT DISTINCT pos FROM sk) p)"]
    out += _yj_pass("yj0", "yjg0")
    for r in range(refinements):
        fine = step / points
        out.append(f"""yjg{r + 1} AS (SELECT b.pos, b.lam + CAST(i AS DOUBLE) * CAST({fine!r} AS DOUBLE) AS lam FROM yj{r} b
            CROSS JOIN (SELECT unnest(range({-points}, {points + 1})) AS i))""")
        out += _yj_pass(f"yj{r + 1}", f"yjg{r + 1}")
        step = fine
    return out


YJ_FIT = _yj_fit_sql()

SCORES_ALL = [
    SKEWED, *YJ_FIT,
    """gate AS (SELECT pos, min(v) AS mn, count(*) FILTER (WHERE v = 0) AS zeros, count(*) FILTER (WHERE v < 0) AS neg
        FROM sk GROUP BY pos)""",
    "types AS (SELECT unnest(['logarithmic', 'reciprocal', 'square-root', 'yeo-johnson', 'square']) AS type)",
    """allowed AS (SELECT g.pos, t.type, (t.type = 'square-root' AND g.neg > 0) AS nan_flag FROM gate g CROSS JOIN types t
        WHERE NOT ((t.type = 'logarithmic' AND g.mn <= 0) OR (t.type = 'reciprocal' AND g.zeros > 0)))""",
    f"""tv AS (SELECT s.pos, a.type, CASE a.type WHEN 'logarithmic' THEN CASE WHEN s.v > 0 THEN ln(s.v) END
        WHEN 'reciprocal' THEN CASE WHEN s.v <> 0 THEN 1e0 / s.v END
        WHEN 'square-root' THEN CASE WHEN s.v >= 0 THEN sqrt(s.v) END
        WHEN 'yeo-johnson' THEN {_yj_sql('s.v', 'y.lam')} ELSE s.v * s.v END AS v
        FROM sk s JOIN allowed a ON s.pos = a.pos LEFT JOIN yj2 y ON y.pos = s.pos)""",
    *sql_anderson("tv", ["pos", "type"], "adt"),
    f"tmom AS (SELECT pos, type, {skew_sql()} AS skew, {kurt_sql()} AS kurt FROM tv GROUP BY pos, type)",
    """scores AS (SELECT d.pos, d.type, d.n, CASE WHEN a.nan_flag THEN NULL ELSE d.a2 END AS a2, d.crit, m.skew, m.kurt
        FROM adt d JOIN tmom m ON d.pos = m.pos AND d.type = m.type JOIN allowed a ON a.pos = d.pos AND a.type = d.type)""",
]

W_SQL = "w AS (SELECT vec_id, CAST(label = 0 AS INTEGER) AS y FROM embeddings)"

KNEE = [
    "rng AS (SELECT pos, min(v) AS lo, max(v) AS hi FROM long GROUP BY pos)",
    "ks AS (SELECT CAST(unnest(range(1, 11)) AS INTEGER) AS k)",
    """bk AS (SELECT l.pos, ks.k, least(floor((l.v - r.lo) / (r.hi - r.lo) * ks.k), ks.k - 1) AS b, l.v
        FROM long l JOIN rng r ON l.pos = r.pos CROSS JOIN ks)""",
    "sse AS (SELECT pos, k, b, var_pop(v) * count(v) AS sse FROM bk GROUP BY pos, k, b)",
    "curve AS (SELECT pos, k, sum(sse) AS wcss FROM sse GROUP BY pos, k)",
    """c1 AS (SELECT pos, k, wcss, min(k) OVER p AS xmin, max(k) OVER p AS xmax, min(wcss) OVER p AS ymin,
        max(wcss) OVER p AS ymax, count(*) OVER p AS m FROM curve WINDOW p AS (PARTITION BY pos))""",
    """c2 AS (SELECT *, (k - xmin) / (xmax - xmin) AS xn,
        (1e0 - (wcss - ymin) / (ymax - ymin)) - (k - xmin) / (xmax - xmin) AS d FROM c1)""",
    """c3 AS (SELECT *, coalesce(lag(d) OVER o, d) AS pd, coalesce(lead(d) OVER o, d) AS nd, lead(d) OVER o AS nxt
        FROM c2 WINDOW o AS (PARTITION BY pos ORDER BY k))""",
    "c4 AS (SELECT *, (d >= pd AND d >= nd) AS is_max, (d <= pd AND d <= nd) AS is_min FROM c3)",
    """c5 AS (SELECT *, last_value(CASE WHEN is_min THEN 0e0 WHEN is_max THEN d - 1e0 / (m - 1) END IGNORE NULLS) OVER o2 AS thr,
        last_value(CASE WHEN is_max THEN k END IGNORE NULLS) OVER o2 AS tx
        FROM c4 WINDOW o2 AS (PARTITION BY pos ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""",
]

NB = [
    "nbmv AS (SELECT max(vp) AS mv FROM (SELECT pos, var_pop(v) AS vp FROM long GROUP BY pos))",
    "nbm AS (SELECT pos, y AS class, avg(v) AS theta, var_pop(v) + 1e-9 * (SELECT mv FROM nbmv) AS var FROM long GROUP BY pos, y)",
    """nbp AS (SELECT y AS class, ln(count(*) / sum(count(*)) OVER ()) AS lp FROM (SELECT DISTINCT vec_id, y FROM long) GROUP BY y)""",
    """nbj AS (SELECT l.vec_id, m.class, sum(-0.5e0 * ln(2e0 * pi() * m.var) - 0.5e0 * (l.v - m.theta) * (l.v - m.theta) / m.var) AS ll
        FROM long l JOIN nbm m ON l.pos = m.pos GROUP BY l.vec_id, m.class)""",
    """nbr AS (SELECT j.vec_id, j.class, row_number() OVER (PARTITION BY j.vec_id ORDER BY j.ll + p.lp DESC, j.class) AS rn
        FROM nbj j JOIN nbp p ON j.class = p.class)""",
]

MCC_EXPR = """coalesce(CAST(tp * tn - fp * fn AS DOUBLE) / CASE WHEN (tp + fp) * (tp + fn) * (tn + fp) * (tn + fn) > 0
    THEN sqrt(CAST(tp + fp AS DOUBLE) * (tp + fn) * (tn + fp) * (tn + fn)) END, 0e0)"""

COUNTS = """count(*) FILTER (WHERE y = 1 AND pred = 1) AS tp, count(*) FILTER (WHERE y = 0 AND pred = 0) AS tn,
    count(*) FILTER (WHERE y = 0 AND pred = 1) AS fp, count(*) FILTER (WHERE y = 1 AND pred = 0) AS fn"""

TRIAL_COLS = "trial_id, val_mcc, val_recall, train_val_mcc, test_mcc, train_val_recall, test_recall"


def _r6_cols(cols: str) -> str:
    return ", ".join(c if c == "trial_id" else f"{r6(c)} AS {c}" for c in (x.strip() for x in cols.split(",")))


NAME_OK = """(len(string_split(split_part(nm, '.csv', 1), '_')) = 3
    AND string_split(split_part(nm, '.csv', 1), '_')[1] = 'wafer'
    AND length(string_split(split_part(nm, '.csv', 1), '_')[2]) = 8
    AND length(string_split(split_part(nm, '.csv', 1), '_')[3]) = 6)"""

ORACLE.update({
    "rows_with_missing": with_views("holes") + """SELECT vec_id, count(*) FILTER (WHERE v IS NULL) AS n_missing FROM holes
        GROUP BY vec_id HAVING count(*) FILTER (WHERE v IS NULL) > 0""",
    "missingness_corr": with_views("holes", *MISS_CORR) + f"SELECT pos_a, pos_b, {r6('r')} AS r FROM mcorr",
    "impute_plan": with_views("sensor_holes", *MISS_CORR, f"""prof AS (SELECT pos, count(*) - count(v) AS nm,
        (count(*) - count(v)) / count(*) AS prop, {skew_sql()} AS skew FROM holes GROUP BY pos)""",
        """strong AS (SELECT c.pos_a AS pos, count(*) AS n_strong FROM mcorr c LEFT JOIN prof p ON p.pos = c.pos_b
        WHERE abs(c.r) > 0.6e0 AND NOT (coalesce(p.prop > 0.8e0, false) AND c.pos_b < c.pos_a) GROUP BY c.pos_a)""")
        + f"""SELECT 'Sensor' || p.pos AS pos, {r6('p.prop')} AS prop_missing, {r6('p.skew')} AS skew, CASE WHEN p.prop > 0.8e0 THEN 'drop'
        WHEN coalesce(s.n_strong, 0) - 1 <= 0 THEN CASE WHEN p.skew > -0.5e0 AND p.skew < 0.5e0 THEN 'mean' ELSE 'median' END
        ELSE 'iterative' END AS strategy FROM prof p LEFT JOIN strong s ON p.pos = s.pos WHERE p.nm > 0""",
    "impute_mean": with_views("holes") + f"SELECT vec_id, pos, {r6('coalesce(v, avg(v) OVER (PARTITION BY pos))')} AS v FROM holes",
    "impute_median": with_views("holes") + f"SELECT vec_id, pos, {r6('coalesce(v, quantile_cont(v, 0.5) OVER (PARTITION BY pos))')} AS v FROM holes",
    "constant_columns": with_views("holes") + "SELECT pos FROM holes GROUP BY pos HAVING min(v) IS NOT DISTINCT FROM max(v)",
    "anderson_normal": with_views("long", *sql_anderson("long", ["pos"], "ad"))
        + f"SELECT pos, n, {r6('a2')} AS a2, {r6('crit')} AS crit, is_normal FROM ad",
    "anderson_holes": with_views("holes", *sql_anderson("holes", ["pos"], "ad"))
        + f"SELECT pos, n, {r6('a2')} AS a2, {r6('crit')} AS crit, is_normal FROM ad",
    "transform_log": f"SELECT o_orderkey, {r6('CASE WHEN o_totalprice > 0 THEN ln(o_totalprice) END')} AS v FROM orders",
    "transform_reciprocal": f"SELECT o_orderkey, {r6('CASE WHEN o_totalprice <> 0 THEN 1e0 / o_totalprice END')} AS v FROM orders",
    "transform_sqrt": f"SELECT o_orderkey, {r6('CASE WHEN o_totalprice >= 0 THEN sqrt(o_totalprice) END')} AS v FROM orders",
    "transform_square": f"SELECT c_custkey, {r6('c_acctbal * c_acctbal')} AS v FROM customer",
    "transform_yeo_johnson": f"""SELECT c_custkey,
        {r6('CASE WHEN c_acctbal >= 0 THEN ln(1e0 + c_acctbal) ELSE -(pow(1e0 - c_acctbal, 2e0) - 1e0) / 2e0 END')} AS yj_0,
        {r6('CASE WHEN c_acctbal >= 0 THEN (pow(c_acctbal + 1e0, 0.5e0) - 1e0) / 0.5e0 ELSE -(pow(1e0 - c_acctbal, 1.5e0) - 1e0) / 1.5e0 END')} AS yj_05,
        {r6('CASE WHEN c_acctbal >= 0 THEN (pow(c_acctbal + 1e0, 2e0) - 1e0) / 2e0 ELSE -ln(1e0 - c_acctbal) END')} AS yj_2
        FROM customer""",
    "score_transforms": with_views("long", *SCORES)
        + f"SELECT pos, type, n, {r6('a2')} AS a2, {r6('crit')} AS crit, {r6('skew')} AS skew, {r6('kurt')} AS kurt FROM scores",
    "pick_transform_alphabetical": with_views("long", *SCORES)
        + f"SELECT pos, min(type) AS type, {r6('min(a2)')} AS a2 FROM scores WHERE a2 < crit GROUP BY pos",
    "pick_transform_best": with_views("long", *SCORES)
        + f"""SELECT pos, type, {r6('a2min')} AS a2 FROM (SELECT pos, type, min(a2) OVER (PARTITION BY pos) AS a2min,
        row_number() OVER (PARTITION BY pos ORDER BY a2, type) AS rn FROM scores WHERE a2 < crit) WHERE rn = 1""",
    "drop_duplicates": with_views("events_dup") + f"SELECT DISTINCT event_id, user_id, event_type, {r6('value')} AS value, props FROM events_dup",
    "duplicate_rows": with_views("events_dup", """dups AS (SELECT event_id, user_id, event_type, value, props, count(*) AS n
        FROM events_dup GROUP BY event_id, user_id, event_type, value, props HAVING count(*) > 1)""")
        + f"SELECT event_id, user_id, event_type, {r6('value')} AS value, props, unnest(generate_series(2, n)) AS copy_no FROM dups",
    "distinct_union": with_views("events_dup") + """SELECT DISTINCT user_id, event_type FROM (SELECT user_id, event_type FROM events
        UNION ALL SELECT user_id, event_type FROM events_dup)""",
    "stratified_split": with_views(W_SQL, "cnt AS (SELECT y, count(*) AS n_c FROM w GROUP BY y)",
        "tot AS (SELECT sum(n_c) AS n, CAST(ceil(0.2e0 * sum(n_c)) AS BIGINT) AS n_test FROM cnt)",
        """q0 AS (SELECT c.y, c.n_c, c.n_c * (t.n - t.n_test) / t.n AS cont, floor(c.n_c * (t.n - t.n_test) / t.n) AS fl,
        t.n - t.n_test AS n_train FROM cnt c CROSS JOIN tot t)""",
        "q1 AS (SELECT *, n_train - sum(fl) OVER () AS need, row_number() OVER (ORDER BY cont - fl DESC, y) AS rk FROM q0)",
        "quota AS (SELECT y, n_c - (fl + CASE WHEN rk <= need THEN 1 ELSE 0 END) AS q_test FROM q1)",
        """rk AS (SELECT vec_id, y, row_number() OVER (PARTITION BY y ORDER BY md5(CAST(vec_id AS VARCHAR) || '42'), vec_id) AS rn
        FROM w)""")
        + "SELECT rk.vec_id, rk.y, CASE WHEN rk.rn <= quota.q_test THEN 'test' ELSE 'train' END AS split FROM rk JOIN quota ON rk.y = quota.y",
    "stratified_folds": with_views(W_SQL) + """SELECT vec_id, y, CAST(ntile(5) OVER (PARTITION BY y
        ORDER BY md5(CAST(vec_id AS VARCHAR) || '42'), vec_id) AS INTEGER) AS fold FROM w""",
    "class_weights": with_views(W_SQL, "cnt AS (SELECT y, count(*) AS n_c FROM w GROUP BY y)")
        + f"""SELECT y, n_c, CAST(sum(n_c) OVER () AS BIGINT) AS n,
        {r6('sum(n_c) OVER () / (count(*) OVER () * n_c)')} AS weight FROM cnt""",
    "recode_label": "SELECT vec_id, raw_y, CASE WHEN raw_y = -1 THEN 0 ELSE raw_y END AS y FROM (SELECT vec_id, CASE WHEN label = 0 THEN 1 ELSE -1 END AS raw_y FROM embeddings)",
    "anova_f": with_views("long", "g AS (SELECT pos, y, count(*) AS n_g, avg(v) AS m_g, var_pop(v) AS v_g FROM long GROUP BY pos, y)",
        """g2 AS (SELECT *, sum(n_g) OVER (PARTITION BY pos) AS nn,
        sum(n_g * m_g) OVER (PARTITION BY pos) / sum(n_g) OVER (PARTITION BY pos) AS grand FROM g)""",
        """an AS (SELECT pos, max(nn) AS nn, count(*) AS k, sum(n_g * (m_g - grand) * (m_g - grand)) AS ssb, sum(n_g * v_g) AS ssw
        FROM g2 GROUP BY pos)""",
        "anf AS (SELECT pos, (ssb / (k - 1)) / CASE WHEN ssw > 0 THEN ssw / (nn - k) END AS f FROM an)")
        + f"SELECT pos, {r6('f')} AS f FROM anf",
    "standardise": with_views("long") + f"""SELECT vec_id, pos, {r6('(v - avg(v) OVER p) / CASE WHEN stddev_pop(v) OVER p > 0 THEN stddev_pop(v) OVER p ELSE 1e0 END')} AS v
        FROM long WINDOW p AS (PARTITION BY pos)""",
    "minmax": with_views("long") + f"""SELECT vec_id, pos, {r6('(v - min(v) OVER p) / CASE WHEN max(v) OVER p - min(v) OVER p > 0 THEN max(v) OVER p - min(v) OVER p ELSE 1e0 END')} AS v
        FROM long WINDOW p AS (PARTITION BY pos)""",
    "scale_split": with_views("long", SKEWED, *sql_anderson("sk", ["pos"], "ad"),
        "skn AS (SELECT s.vec_id, s.pos, s.v, a.is_normal FROM sk s JOIN ad a ON s.pos = a.pos)")
        + f"""SELECT vec_id, pos, {r6('''CASE WHEN is_normal THEN (v - avg(v) OVER p) / CASE WHEN stddev_pop(v) OVER p > 0 THEN stddev_pop(v) OVER p ELSE 1e0 END
        ELSE (v - min(v) OVER p) / CASE WHEN max(v) OVER p - min(v) OVER p > 0 THEN max(v) OVER p - min(v) OVER p ELSE 1e0 END END''')} AS v
        FROM skn WINDOW p AS (PARTITION BY pos)""",
    "kmeans_k1_cost": with_views("long") + f"SELECT {r6('sum(sse)')} AS cost FROM (SELECT pos, var_pop(v) * count(v) AS sse FROM long GROUP BY pos)",
    "sketch_quantiles": with_views("long") + """SELECT pos, CAST(p AS DOUBLE) AS p, count(v) AS n_values, TRUE AS rank_holds
        FROM long, (VALUES (0.05), (0.25), (0.5), (0.75), (0.95)) AS t(p) WHERE v IS NOT NULL GROUP BY pos, p""",
    "kmeans_curve": with_views("long") + f"""SELECT k, (SELECT count(DISTINCT vec_id) FROM long) AS n_items,
        CASE WHEN k = 1 THEN (SELECT {r6('sum(sse)')} FROM (SELECT pos, var_pop(v) * count(v) AS sse FROM long GROUP BY pos)) END AS first_cost,
        TRUE AS cost_agrees, TRUE AS not_above FROM range(1, 11) AS t(k)""",
    "knee": with_views("long", *KNEE) + """SELECT pos, CAST(arg_min(tx, k) FILTER (WHERE tx IS NOT NULL AND xn < 1 AND nxt < thr) AS BIGINT) AS knee
        FROM c5 GROUP BY pos""",
    "cluster_dummies": "SELECT vec_id, " + ", ".join(f"CASE WHEN label = {i} THEN 1 ELSE 0 END AS c{i}" for i in range(1, 10)) + " FROM embeddings",
    "gaussian_nb_score": with_views("long", *NB) + "SELECT vec_id, class AS pred FROM nbr WHERE rn = 1",
    "confusion": with_views("preds") + "SELECT y, pred, count(*) AS n FROM preds GROUP BY y, pred",
    "mcc": with_views("preds", f"cnt AS (SELECT {COUNTS} FROM preds)") + f"SELECT {r6(MCC_EXPR)} AS mcc FROM cnt",
    "macro_recall": with_views("preds") + f"""SELECT {r6('avg(r)')} AS macro_recall FROM (SELECT y,
        avg(CASE WHEN pred = y THEN 1e0 ELSE 0e0 END) AS r FROM preds GROUP BY y)""",
    "classification_report": with_views("preds",
        """pt AS (SELECT y AS label, count(*) AS support, count(*) FILTER (WHERE pred = y) AS tp FROM preds GROUP BY y)""",
        "pp AS (SELECT pred AS label, count(*) AS npred FROM preds GROUP BY pred)",
        """cls AS (SELECT coalesce(pt.label, pp.label) AS label, coalesce(support, 0) AS support, coalesce(tp, 0) AS tp,
        coalesce(npred, 0) AS npred FROM pt FULL JOIN pp ON pt.label = pp.label)""",
        """cls2 AS (SELECT label, support, tp, coalesce(tp / CASE WHEN npred > 0 THEN npred END, 0e0) AS precision,
        coalesce(tp / CASE WHEN support > 0 THEN support END, 0e0) AS recall FROM cls)""",
        """cls3 AS (SELECT *, coalesce(2 * precision * recall / CASE WHEN precision + recall > 0 THEN precision + recall END, 0e0) AS f1_score FROM cls2)""",
        """tot AS (SELECT CAST(sum(support) AS DOUBLE) AS n, sum(tp) AS ntp, avg(precision) AS mp, avg(recall) AS mr, avg(f1_score) AS mf,
        sum(precision * support) AS wp, sum(recall * support) AS wr, sum(f1_score * support) AS wf FROM cls3)""")
        + f"""SELECT CAST(label AS VARCHAR) AS label, {r6('precision')} AS precision, {r6('recall')} AS recall, {r6('f1_score')} AS f1_score,
            {r6('support')} AS support FROM cls3
        UNION ALL SELECT 'accuracy', {r6('ntp / n')}, {r6('ntp / n')}, {r6('ntp / n')}, {r6('n')} FROM tot
        UNION ALL SELECT 'macro avg', {r6('mp')}, {r6('mr')}, {r6('mf')}, {r6('n')} FROM tot
        UNION ALL SELECT 'weighted avg', {r6('wp / n')}, {r6('wr / n')}, {r6('wf / n')}, {r6('n')} FROM tot""",
    "cv_scores": with_views("preds", f"c AS (SELECT side, fold, {COUNTS} FROM preds GROUP BY side, fold)",
        "rr AS (SELECT side, fold, avg(r) AS macro_recall FROM (SELECT side, fold, y, avg(CASE WHEN pred = y THEN 1e0 ELSE 0e0 END) AS r FROM preds GROUP BY side, fold, y) GROUP BY side, fold)",
        f"m AS (SELECT c.side, c.fold, {MCC_EXPR} AS mcc, rr.macro_recall FROM c JOIN rr ON c.side = rr.side AND c.fold = rr.fold)")
        + f"SELECT side, {r6('avg(mcc)')} AS mcc, {r6('avg(macro_recall)')} AS macro_recall, count(*) AS n_folds FROM m GROUP BY side",
    "pareto_front": with_views("trials") + f"""SELECT {_r6_cols(TRIAL_COLS)} FROM trials t WHERE NOT EXISTS (SELECT 1 FROM trials b
        WHERE b.val_mcc >= t.val_mcc AND b.val_recall >= t.val_recall AND (b.val_mcc > t.val_mcc OR b.val_recall > t.val_recall))""",
    "drop_useless": with_views("trials") + f"SELECT {_r6_cols(TRIAL_COLS)} FROM trials WHERE train_val_mcc > 0 AND test_mcc > 0",
    "select_best": with_views("trials", """g AS (SELECT * FROM trials WHERE train_val_mcc > 0 AND test_mcc > 0
        AND abs(train_val_mcc - test_mcc) / train_val_mcc < 0.1e0 AND abs(train_val_recall - test_recall) / train_val_recall < 0.1e0)""",
        "mx AS (SELECT max(test_mcc) AS mm, max(test_recall) AS mr FROM g)")
        + f"""SELECT {_r6_cols(TRIAL_COLS)}, num_features, clustering FROM g CROSS JOIN mx WHERE test_recall = mr
        ORDER BY CASE WHEN test_mcc = mm AND test_recall = mr THEN 0 ELSE 1 END, num_features, clustering, trial_id LIMIT 1""",
    "leaderboard": with_views("trials") + f"""SELECT trial_id, {r6('test_mcc')} AS test_mcc,
        row_number() OVER (ORDER BY test_mcc DESC, trial_id) AS rank FROM trials""",
    "file_name_check": with_views("names") + f"SELECT page_id, nm, {NAME_OK} AS ok FROM names",
    "file_verdicts": with_views("names") + f"""SELECT nm, count(*) AS n_deliveries, {NAME_OK} AS ok,
        CASE WHEN NOT {NAME_OK} THEN 'invalid file name' END AS reason FROM names GROUP BY nm""",
    "select_k_best": with_views("long", "g AS (SELECT pos, y, count(*) AS n_g, avg(v) AS m_g, var_pop(v) AS v_g FROM long GROUP BY pos, y)",
        """g2 AS (SELECT *, sum(n_g) OVER (PARTITION BY pos) AS nn,
        sum(n_g * m_g) OVER (PARTITION BY pos) / sum(n_g) OVER (PARTITION BY pos) AS grand FROM g)""",
        """an AS (SELECT pos, max(nn) AS nn, count(*) AS k, sum(n_g * (m_g - grand) * (m_g - grand)) AS ssb, sum(n_g * v_g) AS ssw
        FROM g2 GROUP BY pos)""",
        "anf AS (SELECT pos, (ssb / (k - 1)) / CASE WHEN ssw > 0 THEN ssw / (nn - k) END AS f FROM an)")
        + f"SELECT pos, {r6('f')} AS f FROM anf WHERE f IS NOT NULL ORDER BY f DESC, pos LIMIT 10",
    "knn_vote": with_views("long",
        """kp AS (SELECT a.vec_id AS q, b.vec_id AS r, sum((a.v - b.v) * (a.v - b.v)) AS d2 FROM long a JOIN long b
        ON a.pos = b.pos AND a.vec_id <> b.vec_id GROUP BY a.vec_id, b.vec_id)""",
        "kr AS (SELECT q, r, row_number() OVER (PARTITION BY q ORDER BY sqrt(d2), r) AS rn FROM kp)",
        "kv AS (SELECT kr.q, e.label, count(*) AS c FROM kr JOIN embeddings e ON e.vec_id = kr.r WHERE kr.rn <= 5 GROUP BY kr.q, e.label)")
        + """SELECT q AS vec_id, label AS pred FROM (SELECT q, label, row_number() OVER (PARTITION BY q ORDER BY c DESC, label) AS rn
        FROM kv) WHERE rn = 1""",
    "fit_yeo_johnson": with_views("long", SKEWED, *YJ_FIT) + f"SELECT pos, {r6('lam')} AS lam FROM yj2",
    "score_transforms_all": with_views("long", *SCORES_ALL)
        + f"SELECT pos, type, n, {r6('a2')} AS a2, {r6('crit')} AS crit, {r6('skew')} AS skew, {r6('kurt')} AS kurt FROM scores",
    "pick_transform_all": with_views("long", *SCORES_ALL)
        + f"SELECT pos, min(type) AS type, {r6('min(a2)')} AS a2 FROM scores WHERE a2 < crit GROUP BY pos",
    "cap_iqr": """WITH b AS (SELECT quantile_cont(value, 0.25) - 1.5e0 * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) AS lo,
        quantile_cont(value, 0.75) + 1.5e0 * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) AS hi FROM events)
        SELECT event_id, """ + r6("least(greatest(value, lo), hi)") + " AS v FROM events CROSS JOIN b",
    "cap_gaussian": """WITH b AS (SELECT avg(value) - 3e0 * stddev_samp(value) AS lo, avg(value) + 3e0 * stddev_samp(value) AS hi FROM events)
        SELECT event_id, """ + r6("least(greatest(value, lo), hi)") + " AS v FROM events CROSS JOIN b",
    "imputation_report": with_views("sensor_holes", *MISS_CORR, f"""prof AS (SELECT pos, count(*) - count(v) AS nm,
        (count(*) - count(v)) / count(*) AS prop, {skew_sql()} AS skew FROM holes GROUP BY pos)""",
        """strong AS (SELECT c.pos_a AS pos, count(*) AS n_strong FROM mcorr c LEFT JOIN prof p ON p.pos = c.pos_b
        WHERE abs(c.r) > 0.6e0 AND NOT (coalesce(p.prop > 0.8e0, false) AND c.pos_b < c.pos_a) GROUP BY c.pos_a)""",
        """plan AS (SELECT p.pos, CASE WHEN p.prop > 0.8e0 THEN 'drop'
        WHEN coalesce(s.n_strong, 0) - 1 <= 0 THEN CASE WHEN p.skew > -0.5e0 AND p.skew < 0.5e0 THEN 'mean' ELSE 'median' END
        ELSE 'iterative' END AS strategy FROM prof p LEFT JOIN strong s ON p.pos = s.pos WHERE p.nm > 0)""")
        + "SELECT 'Sensor' || pos AS Column_Name, strategy AS Impute_Strategy FROM plan WHERE strategy <> 'drop'",
    "drop_constant": with_views("holes", "const AS (SELECT pos FROM holes GROUP BY pos HAVING min(v) IS NOT DISTINCT FROM max(v))")
        + "SELECT pos, count(*) AS n_rows FROM holes WHERE pos NOT IN (SELECT pos FROM const) GROUP BY pos",
    "append_compile": with_views("events_dup") + f"SELECT DISTINCT event_id, user_id, event_type, {r6('value')} AS value, props FROM events_dup",
    "delivery_history": with_views("events_dup") + f"""SELECT event_id, user_id, event_type, {r6('value')} AS value, NULL AS props FROM events_dup WHERE event_type <> 'purchase'
        UNION SELECT event_id, user_id, event_type, {r6('value')}, props FROM events_dup""",
    "delivery_verdicts": "SELECT * FROM (VALUES " + ", ".join(
        f"('{DELIVERIES[t]}', {str(r is None).lower()}, {'NULL' if r is None else repr(r)})" for t, r in (
            ("view", None), ("click", "invalid file name"), ("signup", "mismatch of number of columns"),
            ("purchase", "columns with all missing values"), ("error", None), ("", "columns with all missing values")))
        + ") t(file_name, ok, reason) WHERE (SELECT count(DISTINCT event_type) FROM events) = 5",
    "delivery_good_rows": with_views("cells") + """SELECT wafer AS "Wafer", CASE s1 WHEN 'value' THEN value END AS "Sensor1", CAST(user_id AS DOUBLE) AS "Sensor2",
        s3 AS "Sensor3", out AS "Output", file_name FROM judged WHERE reason IS NULL""",
    "delivery_rejected_rows": with_views("cells") + """SELECT file_name, wafer AS "Wafer", reason FROM judged WHERE reason IS NOT NULL""",
    "header_widths": "SELECT * FROM (VALUES " + ", ".join(f"('{n}', {4 if t == 'signup' else 5})" for t, n in DELIVERIES.items())
        + ") t(file_name, n_header_cols) WHERE (SELECT count(DISTINCT event_type) FROM events) = 5",
    "all_null_columns": with_views("cells") + """SELECT file_name, CAST(CASE event_type WHEN 'signup' THEN 1 WHEN 'purchase' THEN 1 ELSE 0 END AS INTEGER) AS n_all_null_cols
        FROM cells GROUP BY file_name, event_type""",
})

_WIDE = "wide AS (SELECT vec_id, CAST(label = 0 AS INTEGER) AS y, " + ", ".join(f"CAST(embedding[{i}] AS DOUBLE) AS e{i}" for i in range(1, 5)) + " FROM embeddings)"
_PENALISED = "least(1e0, greatest(-1e0, -sign({g}) * greatest(abs({g}) - 0.5e0, 0) / ({h} + 1.5e0)))"


def _score(g: str, h: str) -> str:
    w = _PENALISED.format(g=g, h=h)
    return f"-({g} * {w} * 2 + ({h} + 1.5e0) * {w} * {w} + 1e0 * abs({w}))"


def _leaf_risk(n: str, k: str) -> str:
    """Gini impurity of ``n`` rows, ``k`` of them of class 1, by their share of all rows."""
    return f"(CASE WHEN {n} = 0 THEN 0 ELSE (1 - ({k} / {n}) * ({k} / {n}) - (1 - {k} / {n}) * (1 - {k} / {n})) * {n} / n END)"


ORACLE.update({
    "boosted_margins": f"WITH {_WIDE}, " + """m AS (SELECT vec_id, 0.25e0
        + CASE WHEN e1 <= 0 THEN CASE WHEN e2 <= 0.05e0 THEN 0.5e0 ELSE -0.25e0 END ELSE CASE WHEN e3 <= -0.05e0 THEN 0.125e0 ELSE -1e0 END END
        + CASE WHEN e4 <= 0.1e0 THEN 0.75e0 ELSE CASE WHEN e1 <= -0.1e0 THEN -0.5e0 ELSE 0.0625e0 END END AS margin FROM wide)
        SELECT vec_id, """ + r6("margin") + """ AS margin, CAST(margin > 0 AS INTEGER) AS pred FROM m""",
    "boosted_root_split": with_views("long") + f""", c AS (SELECT pos, v, count(*) AS c, sum(0.5e0 - y) AS g FROM long GROUP BY pos, v),
        r AS (SELECT *, coalesce(sum(c) OVER (PARTITION BY pos ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(c) OVER (PARTITION BY pos) AS n FROM c),
        b AS (SELECT pos, c, g, dense_rank() OVER (PARTITION BY pos ORDER BY floor(CAST(before * 15 AS DOUBLE) / n)) AS bin FROM r),
        s AS (SELECT pos, bin, CAST(sum(g) AS DOUBLE) AS g, CAST(sum(c) * 0.25e0 AS DOUBLE) AS h FROM b GROUP BY pos, bin),
        k AS (SELECT pos, bin, sum(g) OVER w AS gl, sum(h) OVER w AS hl, sum(g) OVER (PARTITION BY pos) AS gt, sum(h) OVER (PARTITION BY pos) AS ht FROM s
              WINDOW w AS (PARTITION BY pos ORDER BY bin ROWS UNBOUNDED PRECEDING)),
        q AS (SELECT *, gt - gl AS gr, ht - hl AS hr FROM k WHERE hl >= 2 AND ht - hl >= 2),
        z AS (SELECT pos, bin, {_score('gl', 'hl')} + {_score('gr', 'hr')} - {_score('gt', 'ht')} AS gain, gl, hl, gr, hr FROM q
        QUALIFY row_number() OVER (PARTITION BY pos ORDER BY gain DESC, bin) = 1)
        SELECT pos, CAST(bin AS BIGINT) AS bin, {r6('gain')} AS gain, {r6('gl')} AS gl, {r6('hl')} AS hl, {r6('gr')} AS gr, {r6('hr')} AS hr FROM z""",
    "pruned_tree": f"WITH {_WIDE}, " + f"""l AS (SELECT vec_id, y, CASE WHEN e1 <= 0 THEN CASE WHEN e2 <= 0.05e0 THEN 1 ELSE 2 END ELSE CASE WHEN e3 <= -0.05e0 THEN 3 ELSE 4 END END AS leaf FROM wide),
        c AS (SELECT CAST(count(*) AS DOUBLE) AS n, {", ".join(f"CAST(count(*) FILTER (leaf = {i}) AS DOUBLE) AS n{i}, CAST(count(*) FILTER (leaf = {i} AND y = 1) AS DOUBLE) AS k{i}" for i in range(1, 5))},
              n1 + n2 AS nl, k1 + k2 AS kl, n3 + n4 AS nr, k3 + k4 AS kr, k1 + k2 + k3 + k4 AS k FROM l),
        r AS (SELECT *, {_leaf_risk('nl', 'kl')} + 0.0005e0 AS alone_l, {_leaf_risk('nr', 'kr')} + 0.0005e0 AS alone_r, {_leaf_risk('n', 'k')} + 0.0005e0 AS alone,
              {_leaf_risk('n1', 'k1')} + {_leaf_risk('n2', 'k2')} + 0.001e0 AS split_l, {_leaf_risk('n3', 'k3')} + {_leaf_risk('n4', 'k4')} + 0.001e0 AS split_r FROM c),
        p AS (SELECT *, alone <= least(alone_l, split_l) + least(alone_r, split_r) AS root, alone_l <= split_l AS cut_l, alone_r <= split_r AS cut_r FROM r)
        SELECT vec_id, CAST(CASE WHEN root THEN 1 ELSE 3 + 2 * CAST(NOT cut_l AS INTEGER) + 2 * CAST(NOT cut_r AS INTEGER) END AS BIGINT) AS n_nodes,
          round(CAST(CASE WHEN root THEN k / n WHEN leaf <= 2 THEN CASE WHEN cut_l THEN kl / nl WHEN leaf = 1 THEN k1 / n1 ELSE k2 / n2 END
          ELSE CASE WHEN cut_r THEN kr / nr WHEN leaf = 3 THEN k3 / n3 ELSE k4 / n4 END END AS DOUBLE), 6) + 0.0 AS share FROM l, p""",
})
ORACLE.update({
    "joint_impute_cells": with_views("holes") + """SELECT CAST(pos AS BIGINT) AS pos, count(v) AS n_observed, CAST(0 AS BIGINT) AS n_changed, count(*) - count(v) AS n_filled,
        CAST(0 AS BIGINT) AS n_left FROM holes GROUP BY pos""",
    "joint_impute_line": with_views("holes") + f""", p AS (SELECT vec_id, max(v) FILTER (pos = 5) AS a, max(v) FILTER (pos = 10) AS b FROM holes GROUP BY vec_id),
        l AS (SELECT regr_slope(a, b) AS slope, regr_intercept(a, b) AS base FROM p)
        SELECT vec_id, {r6("coalesce(a, base + slope * b)")} AS e5, {r6("b")} AS e10 FROM p, l""",
    "kmeans_nearest": "SELECT count(*) AS n_items, least(count(*), 4) AS n_clusters, CAST(0 AS BIGINT) AS n_not_nearest FROM embeddings",
})
