"""The registered queries restated as plain SQL for an independent engine.

Each statement follows the definition (range joins, per-window LAG, COUNT DISTINCT, row-level ranks)
and shares no method with the Spark plans. Whole tables are read everywhere.
"""

from __future__ import annotations

ORACLES: dict[str, str] = {}

TX = """tx AS (
  SELECT o_orderkey AS invoice, l_partkey AS stock,
         CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS qty,
         o_orderdate AS d, l_extendedprice / l_quantity AS price, o_custkey AS cust,
         l_extendedprice AS u
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
EV = """tx AS (
  SELECT event_id AS invoice, event_type AS stock,
         CAST(CASE event_type WHEN 'purchase' THEN 1 WHEN 'error' THEN -1 ELSE 0 END AS DOUBLE) AS qty,
         ts AS d, value AS price, user_id AS cust,
         CASE WHEN event_type IN ('purchase', 'error') THEN value ELSE 0 END AS u
  FROM events)"""
RAW = (
    TX
    + """,
raw AS (
  SELECT invoice, stock, qty, d, price, CASE WHEN o_orderpriority NOT LIKE '4%' THEN cust END AS cust
  FROM tx JOIN orders ON invoice = o_orderkey, range(2) r(k) WHERE k = 0 OR qty < 0)"""
)


def calendar(end: str, origin: str, unit: str, f: int, o: int, step: int, fits: str) -> str:
    """``cal``: snapshot windows up to the coverage end. ``fits`` is ``oe`` (labelled) or ``fe`` (scorable)."""
    add = "to_months" if unit == "month" else "to_days"
    return f"""cov AS (SELECT {end} AS c),
c0 AS (SELECT CAST(i AS INTEGER) AS n, TIMESTAMP '{origin}' + {add}(CAST((i - 1) * {step} AS INTEGER)) AS fs FROM range(1, 2000) r(i)),
c1 AS (SELECT n, fs, fs + {add}({f}) AS fe FROM c0),
cal AS (SELECT n, fs, fe, fs + to_microseconds((epoch_us(fe) - epoch_us(fs)) // 2) AS mid, fe + {add}({o}) AS oe
        FROM c1, cov WHERE CASE '{fits}' WHEN 'oe' THEN fe + {add}({o}) ELSE fe END <= c)"""


def order_cal(fits: str) -> str:
    return calendar("(SELECT max(o_orderdate) FROM orders)", "1995-01-01", "month", 5, 3, 3, fits)


EVENT_CAL = calendar("(SELECT max(ts) FROM events)", "2024-01-01", "day", 10, 5, 5, "oe")

ASOF_ORDERS = """cal AS (
  SELECT CAST(strftime(a, '%Y%m%d') AS INTEGER) AS n, a - to_months(5) AS fs, a AS fe,
         (a - to_months(5)) + to_microseconds((epoch_us(a) - epoch_us(a - to_months(5))) // 2) AS mid, a AS oe
  FROM (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS a FROM orders))"""
ASOF_EVENTS = """cal AS (
  SELECT CAST(strftime(a, '%Y%m%d') AS INTEGER) AS n, a - to_days(10) AS fs, a AS fe, a - to_days(5) AS mid, a AS oe
  FROM (SELECT DISTINCT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS a FROM events))"""

FEATURES = """f AS (SELECT c.n, c.fs, c.fe, c.mid, t.* FROM tx t JOIN cal c ON t.d >= c.fs AND t.d < c.fe),
spine AS (SELECT DISTINCT n, fe, cust FROM f),
side AS (
  SELECT n, cust,
    sum(u) FILTER (qty > 0) AS su, sum(qty) FILTER (qty > 0) AS si,
    count(DISTINCT invoice) FILTER (qty > 0) AS st, max(CAST(d AS DATE)) FILTER (qty > 0) AS last_sale,
    sum(u) FILTER (qty < 0) AS ru, sum(qty) FILTER (qty < 0) AS ri,
    count(DISTINCT invoice) FILTER (qty < 0) AS rt,
    sum(u) FILTER (qty > 0 AND d >= mid) AS recent_u, sum(u) FILTER (qty > 0 AND d < mid) AS early_u,
    count(DISTINCT invoice) FILTER (qty > 0 AND d >= mid) AS recent_t,
    count(DISTINCT invoice) FILTER (qty > 0 AND d < mid) AS early_t
  FROM f GROUP BY n, cust),
gap0 AS (SELECT DISTINCT n, cust, sign(qty) AS s, invoice, d FROM f WHERE qty <> 0),
gap1 AS (SELECT n, cust, s, date_sub('day', lag(d) OVER (PARTITION BY n, cust, s ORDER BY d), d) AS g FROM gap0),
gap AS (SELECT n, cust, avg(g) FILTER (s > 0) AS sale_gap, avg(g) FILTER (s < 0) AS return_gap FROM gap1 GROUP BY n, cust),
first_sale AS (SELECT cust, min(d) AS d0 FROM tx WHERE qty > 0 GROUP BY cust),
feat AS (
  SELECT s.n AS snapshot_no, s.cust AS CustomerID, s.fe AS snapshot_date,
    coalesce(su, 0) AS total_sales_revenue, abs(coalesce(si, 0)) AS total_items_purchased,
    coalesce(st, 0) AS total_sale_txs, sale_gap AS avg_sale_days, date_diff('day', last_sale, CAST(fe AS DATE)) AS recency,
    coalesce(ru, 0) AS total_return_amount, abs(coalesce(ri, 0)) AS total_items_returned,
    coalesce(rt, 0) AS total_return_txs, coalesce(return_gap, 0) AS avg_return_days,
    CASE WHEN d0 < fe THEN date_sub('day', d0, fe) END AS tenure_days,
    coalesce(recent_u, 0) AS recent_revenue,
    CASE WHEN coalesce(su, 0) > 0 THEN (coalesce(recent_u, 0) - coalesce(early_u, 0)) / CAST(su AS DOUBLE) ELSE 0 END AS revenue_momentum,
    recent_t AS recent_tx_count,
    CASE WHEN recent_t + early_t > 0 THEN (recent_t - early_t) / CAST(recent_t + early_t AS DOUBLE) ELSE 0 END AS tx_count_momentum,
    NOT EXISTS (SELECT 1 FROM tx o JOIN cal c ON c.n = s.n WHERE o.cust = s.cust AND o.qty > 0 AND o.d >= c.fe AND o.d < c.oe) AS inactive
  FROM spine s LEFT JOIN side USING (n, cust) LEFT JOIN gap USING (n, cust) LEFT JOIN first_sale ON first_sale.cust = s.cust)"""

FEATURE_NAMES = (
    "total_sales_revenue total_items_purchased total_sale_txs avg_sale_days recency total_return_amount "
    "total_items_returned total_return_txs avg_return_days tenure_days recent_revenue revenue_momentum "
    "recent_tx_count tx_count_momentum"
).split()

# Predictions: both roles of every scorable snapshot, with the label where the outcome is covered.
PRED = """seen AS (
  SELECT c.n, c.fe, c.oe, t.cust, max(CAST(d AS DATE)) FILTER (qty > 0) AS last_sale
  FROM tx t JOIN cal c ON t.d >= c.fs AND t.d < c.fe GROUP BY ALL),
base AS (SELECT *, CAST(date_diff('day', last_sale, CAST(fe AS DATE)) AS DOUBLE) AS rec FROM seen),
pred AS (
  SELECT n, fe AS snapshot_date, oe, cust AS CustomerID, role AS prediction_role, version AS model_version, t AS threshold_used,
    rec, coalesce(rec / (rec + h), 0.5) AS p,
    CASE WHEN coalesce(rec / (rec + h), 0.5) >= t THEN 1 ELSE 0 END AS predicted_churn
  FROM base, (VALUES ('official', 'v2', CAST(30 AS DOUBLE), CAST(0.5 AS DOUBLE)), ('shadow', 'v1', CAST(60 AS DOUBLE), CAST(0.4 AS DOUBLE))) r(role, version, h, t)),
res AS (
  SELECT p.*, CASE WHEN EXISTS (SELECT 1 FROM tx o WHERE o.cust = p.CustomerID AND o.qty > 0 AND o.d >= p.snapshot_date AND o.d < p.oe)
    THEN 0 ELSE 1 END AS y
  FROM pred p, cov WHERE p.oe <= c)"""
SCORED = f"{TX},\n{order_cal('fe')},\n{PRED}"
SET = "snapshot_date, model_version, prediction_role"

# Row-level ranks and per-score cumulative counts.
CLASS = f"""cm AS (
  SELECT {SET}, count(*) AS n,
    count(*) FILTER (predicted_churn = 0 AND y = 0) AS tn, count(*) FILTER (predicted_churn = 1 AND y = 0) AS fp,
    count(*) FILTER (predicted_churn = 0 AND y = 1) AS fn, count(*) FILTER (predicted_churn = 1 AND y = 1) AS tp,
    avg(p) AS mp, avg(y) AS rate, avg(predicted_churn) AS prate, avg((p - y) * (p - y)) AS brier, avg(threshold_used) AS mt
  FROM res GROUP BY ALL),
cmm AS (
  SELECT *, (tp + tn) / CAST(n AS DOUBLE) AS acc,
    CASE WHEN tp + fp = 0 THEN 0 ELSE tp / CAST(tp + fp AS DOUBLE) END AS prec,
    CASE WHEN tp + fn = 0 THEN 0 ELSE tp / CAST(tp + fn AS DOUBLE) END AS rcl,
    CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / CAST(2 * tp + fp + fn AS DOUBLE) END AS fone
  FROM cm)"""
RANKED = f"""g AS (SELECT {SET}, p, sum(y) AS pos, sum(1 - y) AS neg FROM res GROUP BY ALL),
h AS (
  SELECT *, sum(neg) OVER up - neg AS neg_below, sum(pos) OVER down AS tps, sum(neg) OVER down AS fps,
    sum(pos) OVER whole AS pp, sum(neg) OVER whole AS nn
  FROM g WINDOW up AS (PARTITION BY {SET} ORDER BY p), down AS (PARTITION BY {SET} ORDER BY p DESC), whole AS (PARTITION BY {SET})),
rk AS (
  SELECT {SET}, CASE WHEN max(pp) > 0 AND max(nn) > 0 THEN sum(pos * (neg_below + neg / 2.0)) / (CAST(max(pp) AS DOUBLE) * max(nn)) END AS auc,
    CASE WHEN max(pp) > 0 AND max(nn) > 0 THEN sum(CAST(pos AS DOUBLE) / pp * tps / (tps + fps)) END AS ap
  FROM h GROUP BY ALL)"""
CALIB = f"""o AS (SELECT *, row_number() OVER (PARTITION BY {SET} ORDER BY p, CustomerID) AS r, count(*) OVER (PARTITION BY {SET}) AS cnt FROM res),
cut AS (SELECT cnt, list(CASE WHEN pos - floor(pos) < 0.5 THEN floor(pos) + 1 + (pos - floor(pos)) ELSE floor(pos) + 2 - (1 - (pos - floor(pos))) END) AS edges
  FROM (SELECT cnt, CAST(i AS DOUBLE) * CAST(0.1 AS DOUBLE) * CAST(100 AS DOUBLE) / CAST(100 AS DOUBLE) * (cnt - 1) AS pos FROM (SELECT DISTINCT cnt FROM o), range(1, 10) z(i)) GROUP BY cnt),
b AS (SELECT o.*, CASE WHEN o.cnt < 10 THEN r ELSE 1 + len(list_filter(edges, lambda w: w < r)) END AS dec FROM o JOIN cut USING (cnt)),
cal10 AS (SELECT {SET}, dec, count(*) AS n, avg(p) AS mp, avg(y) AS rate, abs(avg(p) - avg(y)) AS gap FROM b GROUP BY ALL),
e AS (SELECT {SET}, sum(n * gap) / sum(n) AS ece FROM cal10 GROUP BY ALL)"""


def psi(rows: str, keys: str) -> str:
    """CTEs ending in ``psi``: ``rows`` holds keys, side and v (NULLs already excluded)."""
    k = keys
    on = " AND ".join(f"a.{c} = x.{c}" for c in keys.split(", "))
    points = ", ".join(repr(i * 0.1) for i in range(10)) + ", 1.0"
    return f"""
q0 AS (SELECT {k}, v, row_number() OVER (PARTITION BY {k} ORDER BY v) - 1 AS i, count(*) OVER (PARTITION BY {k}) AS cnt FROM {rows} WHERE side = 'baseline'),
q1 AS (SELECT DISTINCT {k}, cnt, pt * (cnt - 1) AS pos FROM q0, (SELECT CAST(unnest([{points}]) AS DOUBLE) AS pt)),
q2 AS (SELECT a.*, lo.v AS lo, hi.v AS hi, pos - floor(pos) AS t FROM q1 a
  JOIN q0 lo ON {on.replace('x.', 'lo.')} AND lo.i = floor(pos) JOIN q0 hi ON {on.replace('x.', 'hi.')} AND hi.i = ceil(pos)),
q3 AS (SELECT {k}, list_sort(list_distinct(list(CASE WHEN t < 0.5 THEN lo + (hi - lo) * t ELSE hi - (hi - lo) * (1 - t) END))) AS edges FROM q2 GROUP BY {k}),
bins AS (SELECT {k}, edges, CAST(unnest(range(greatest(len(edges) - 1, 1))) AS BIGINT) AS bin FROM q3),
placed AS (SELECT a.*, x.edges, len(list_filter(x.edges[2:len(x.edges) - 1], lambda z: z <= a.v)) AS bin FROM {rows} a JOIN q3 x ON {on}),
cnts AS (SELECT {k}, bin, count(*) FILTER (side = 'baseline') AS bn, count(*) FILTER (side = 'current') AS cn FROM placed GROUP BY {k}, bin),
full_bins AS (SELECT bins.*, coalesce(bn, 0) AS bn, coalesce(cn, 0) AS cn FROM bins LEFT JOIN cnts USING ({k}, bin)),
shares AS (SELECT *, len(edges) - 1 AS kk, (bn + 1) / CAST(sum(bn) OVER w + len(edges) - 1 AS DOUBLE) AS bp,
  (cn + 1) / CAST(sum(cn) OVER w + len(edges) - 1 AS DOUBLE) AS cp, sum(cn) OVER w AS ctot FROM full_bins WINDOW w AS (PARTITION BY {k})),
psi AS (SELECT {k}, CASE WHEN max(ctot) = 0 THEN NULL WHEN max(kk) < 2 THEN 0 ELSE sum((cp - bp) * ln(cp / bp)) END AS psi FROM shares GROUP BY {k})"""


def out(ctes: str, cols: str, tail: str) -> str:
    """Final SELECT with plain types. ``cols``: ``name:kind[=expr]`` separated by ``;``.

    Kinds: i bigint, f double to six places, d date text, t time text, s text, b boolean.
    """
    wrap = {
        "i": "CAST({} AS BIGINT)",
        "f": "round_even(CAST({} AS DOUBLE) * 1e6, 0) / 1e6 + 0.0",
        "d": "strftime({}, '%Y-%m-%d')",
        "t": "strftime({}, '%Y-%m-%d %H:%M:%S.%f')",
        "s": "CAST({} AS VARCHAR)",
        "b": "CAST({} AS BOOLEAN)",
    }
    parts = []
    for col in cols.split(";"):
        head, _, expr = col.strip().partition("=")
        name, _, kind = head.strip().partition(":")
        parts.append(f"{wrap[kind].format((expr or name).strip())} AS {name}")
    return f"WITH {ctes}\nSELECT {', '.join(parts)}\n{tail}"


def add(name: str, ctes: str, cols: str, tail: str) -> None:
    ORACLES[name] = out(ctes, cols, tail)


LINE = "Invoice:i=invoice; StockCode:i=stock; Quantity:f=qty; InvoiceDate:t=d; Price:f=price; CustomerID:i=cust"
MONTHLY = "mv AS (SELECT CAST(date_trunc('month', d) AS DATE) AS month, count(DISTINCT invoice) AS tx_count, count(DISTINCT cust) AS customer_count, sum(sign(qty) * u) AS revenue FROM tx GROUP BY 1)"
LONG = "lg AS (SELECT month, 'tx_count' AS metric, CAST(tx_count AS DOUBLE) AS value FROM mv UNION ALL SELECT month, 'customer_count', CAST(customer_count AS DOUBLE) FROM mv UNION ALL SELECT month, 'revenue', CAST(revenue AS DOUBLE) FROM mv)"

# --- sources and cleaning
add("scan_transactions", TX, LINE, "FROM tx")
add("clean_transactions", RAW, LINE, "FROM (SELECT DISTINCT * FROM raw WHERE cust IS NOT NULL)")
add("curate_union_dedup", TX, LINE, "FROM (SELECT DISTINCT invoice, stock, qty, d, price, cust FROM tx)")
add("point_in_time_union", TX, LINE, "FROM tx WHERE d < TIMESTAMP '2001-05-01'")
add(
    "feed_overlap", TX,
    "bootstrap_max:t=a; replay_min:t=b; overlaps:b=a >= b",
    "FROM (SELECT max(d) FILTER (d < TIMESTAMP '1998-01-02') AS a, min(d) FILTER (d >= TIMESTAMP '1998-01-01') AS b FROM tx)",
)
add(
    "history_schema_evolution", f"{TX}, {MONTHLY}",
    "snapshot_date:d=month; tx_count:i; revenue:f; customer_count:i=CASE WHEN month >= DATE '1998-05-01' THEN customer_count END",
    "FROM mv",
)
add(
    "label_upsert", SCORED + """,
off AS (SELECT snapshot_date, CustomerID, oe FROM pred WHERE prediction_role = 'official'),
cand AS (
  SELECT o.*, oe AS until, '2001-09-01T00:00:00Z' AS resolved_at FROM off o, cov WHERE oe <= c
  UNION ALL SELECT o.*, snapshot_date + to_months(1), '2001-01-01T00:00:00Z' FROM off o, cov WHERE snapshot_date + to_months(1) <= c),
lab AS (SELECT *, row_number() OVER (PARTITION BY snapshot_date, CustomerID ORDER BY resolved_at DESC) AS rn FROM cand)""",
    """snapshot_date:d; CustomerID:i; outcome_end:t=until; resolved_at:s;
    inactive_90d:i=CASE WHEN EXISTS (SELECT 1 FROM tx o WHERE o.cust = lab.CustomerID AND o.qty > 0 AND o.d >= lab.snapshot_date AND o.d < lab.until) THEN 0 ELSE 1 END""",
    "FROM lab WHERE rn = 1",
)
add(
    "reference_sample", SCORED,
    "snapshot_date:d; CustomerID:i; churn_probability:f=p",
    """FROM (SELECT * FROM res WHERE prediction_role = 'official'
    ORDER BY md5('42|' || strftime(snapshot_date, '%Y-%m-%d') || '|' || CAST(CustomerID AS VARCHAR)) LIMIT 2000)""",
)

# --- quality
add(
    "structural_quality", RAW + """,
q AS (SELECT count(*) AS n, avg(CASE WHEN cust IS NULL THEN 1.0 ELSE 0.0 END) AS nc FROM raw),
dl AS (SELECT count(*) AS k FROM (SELECT DISTINCT invoice, stock, qty, d FROM raw)),
ck AS (
  SELECT 'empty_file' AS check_name, CASE WHEN n = 0 THEN 1.0 ELSE 0.0 END AS observed, 0.0 AS limit_value FROM q
  UNION ALL SELECT 'date_not_parsed', 0, 0 UNION ALL SELECT 'quantity_not_numeric', 0, 0 UNION ALL SELECT 'price_not_numeric', 0, 0
  UNION ALL SELECT 'null_customer_fraction', nc, 0.95 FROM q
  UNION ALL SELECT 'duplicate_line_rate', (n - k) / CAST(n AS DOUBLE), 0.20 FROM q, dl)""",
    "check_name:s; observed:f; limit_value:f; passed:b=observed <= limit_value",
    "FROM ck",
)
add(
    "batch_bounds_violations", TX,
    "violations:i=count(*) FILTER (d < TIMESTAMP '2001-07-01' OR d >= TIMESTAMP '2001-08-01'); rows:i=count(*)",
    "FROM tx",
)
add("monthly_volume", f"{TX}, {MONTHLY}", "month:d; tx_count:i; customer_count:i; revenue:f", "FROM mv")
BASE = """ranked AS (SELECT *, row_number() OVER (PARTITION BY metric ORDER BY month DESC) AS age FROM lg),
bl AS (SELECT metric, avg(value) AS mean, nullif(stddev_pop(value), 0) AS std FROM ranked WHERE age <= 12 GROUP BY metric)"""
SEV = "status:s=CASE WHEN z IS NULL THEN 'SKIPPED' WHEN abs(z) > 5 THEN 'ERROR' WHEN abs(z) > 3 THEN 'WARNING' ELSE 'OK' END"
add("monthly_baseline", f"{TX}, {MONTHLY}, {LONG}, {BASE}", "metric:s; mean:f; std:f", "FROM bl")
add(
    "volume_anomalies", f"""{TX}, {MONTHLY}, {LONG},
tr AS (SELECT month, metric, value, avg(value) OVER w AS mean, nullif(stddev_pop(value) OVER w, 0) AS std FROM lg
  WINDOW w AS (PARTITION BY metric ORDER BY month ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING)),
z AS (SELECT *, (value - mean) / std AS z FROM tr)""",
    f"month:d; metric:s; value:f; mean:f; std:f; z_score:f=z; {SEV}",
    "FROM z",
)
add(
    "volume_check", f"""{TX.replace('tx AS', 'al AS')}, tx AS (SELECT * FROM al WHERE d < TIMESTAMP '2001-07-01'), {MONTHLY}, {LONG}, {BASE},
nw AS (SELECT count(DISTINCT invoice) AS a, count(DISTINCT cust) AS b, sum(sign(qty) * u) AS c FROM al WHERE d >= TIMESTAMP '2001-07-01'),
ob AS (SELECT 'tx_count' AS metric, CAST(a AS DOUBLE) AS value FROM nw UNION ALL SELECT 'customer_count', CAST(b AS DOUBLE) FROM nw UNION ALL SELECT 'revenue', CAST(c AS DOUBLE) FROM nw),
z AS (SELECT metric, value, mean, std, (value - mean) / std AS z FROM ob JOIN bl USING (metric))""",
    f"metric:s; value:f; mean:f; std:f; z_score:f=z; {SEV}",
    "FROM z",
)
add(
    "prediction_quality", SCORED + """,
w AS (SELECT snapshot_date, CustomerID, predicted_churn, CASE WHEN prediction_role = 'shadow' THEN p * 1.5 ELSE p END AS p FROM pred),
v AS (SELECT snapshot_date, count(*) AS rows, count(*) FILTER (CustomerID IS NULL) AS a,
  count(CustomerID) - count(DISTINCT CustomerID) AS b, count(*) FILTER (p IS NULL OR p < 0 OR p > 1) AS c,
  count(*) FILTER (predicted_churn NOT IN (0, 1)) AS e FROM w GROUP BY snapshot_date)""",
    "snapshot_date:d; rows:i; null_ids:i=a; duplicate_ids:i=b; probability_out_of_range:i=c; class_out_of_range:i=e; passed:b=a + b + c + e = 0",
    "FROM v",
)

# --- calendars
WINDOWS = "snapshot_no:i=n; feature_start:t=fs; feature_end:t=fe; midpoint:t=mid; outcome_start:t=fe; outcome_end:t=oe"
add("snapshot_calendar", order_cal("fe"), WINDOWS, "FROM cal")
add("event_calendar", EVENT_CAL, WINDOWS, "FROM cal")
ORDER_OE = calendar("(SELECT max(d) FROM tx)", "1995-01-01", "month", 5, 3, 3, "oe")
add("available_snapshots", f"{TX}, {ORDER_OE}", "coverage_end:t=(SELECT c FROM cov); available:i=count(*)", "FROM cal")
add(
    "step_recommendation", f"""{TX}, cv AS (SELECT max(d) AS c FROM tx),
s AS (SELECT CAST(unnest(range(1, 13)) AS INTEGER) AS step),
av AS (SELECT step, (SELECT count(*) FROM range(0, 400) r(i), cv WHERE TIMESTAMP '1995-01-01' + to_months(CAST(i * step + 8 AS INTEGER)) <= c) AS available FROM s),
best AS (SELECT greatest(1, coalesce(min(step) FILTER (available < 10) - 1, 12)) AS k FROM av)""",
    "step:i; available:i; fits:b=available >= 10; recommended:b=step = k",
    "FROM av, best",
)
ROLL = "sp AS (SELECT n, CASE WHEN m - n >= 2 THEN 'train' WHEN m - n = 1 THEN 'val' ELSE 'test' END AS split FROM cal, (SELECT max(n) AS m FROM cal) WHERE m - n < 4 AND m >= 4)"
add("rolling_split", f"{TX}, {ORDER_OE}, {ROLL}", "snapshot_no:i=n; split:s", "FROM sp")
add(
    "forward_folds", f"{TX}, {ORDER_OE}",
    "fold:i=v.n - 1; role:s=CASE WHEN t.n = v.n THEN 'validate' ELSE 'train' END; snapshot_no:i=t.n",
    "FROM cal v JOIN cal t ON t.n <= v.n WHERE v.n >= 2",
)
add("fixed_split", f"{TX}, {ORDER_OE}", "snapshot_no:i=n; split:s=CASE WHEN n <= 3 THEN 'train' WHEN n <= 5 THEN 'val' ELSE 'test' END", "FROM cal WHERE n <= 6")
MONTHS = "mo AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS a FROM orders)"
add(
    "cadence_gates", MONTHS,
    "as_of:d=a; delayed_evaluation_due:b=a >= DATE '1998-09-01'; retrain_due:b=a >= DATE '1998-09-01' AND month(a) IN (3, 6, 9, 12)",
    "FROM mo",
)
add(
    "retrain_readiness", f"""{TX}, cv AS (SELECT DISTINCT CAST(date_trunc('month', d) AS TIMESTAMP) AS c FROM tx),
av AS (SELECT c, (SELECT count(*) FROM range(0, 400) r(i) WHERE TIMESTAMP '1995-01-01' + to_months(CAST(i * 3 + 8 AS INTEGER)) <= c) AS a FROM cv),
ch AS (SELECT *, CASE WHEN a > 4 THEN a - CASE WHEN month(c) % 2 = 0 THEN 1 ELSE 0 END END AS last FROM av)""",
    """coverage_end:t=c; available:i=a; champion_latest_snapshot:i=last; needed:i=4;
    retrain_skipped:b=a < 4 OR coalesce(a <= last, false);
    reason:s=CASE WHEN a < 4 THEN 'not_enough_snapshots' WHEN a <= last THEN 'no_new_snapshot' END""",
    "FROM ch",
)

# --- features
MEMBER = """mb AS (
  SELECT c.n, 'feature' AS role, t.* FROM tx t JOIN cal c ON t.d >= c.fs AND t.d < c.fe
  UNION ALL SELECT c.n, 'outcome', t.* FROM tx t JOIN cal c ON t.d >= c.fe AND t.d < c.oe)"""
add(
    "snapshot_membership", f"{TX}, {order_cal('oe')}, {MEMBER}",
    "snapshot_no:i=n; role:s; Invoice:i=invoice; StockCode:i=stock; Quantity:f=qty; InvoiceDate:t=d; CustomerID:i=cust",
    "FROM mb",
)
add(
    "feature_outcome_split", f"{TX}, {order_cal('oe')}, {MEMBER}",
    "snapshot_no:i=n; role:s; CustomerID:i=cust; lines:i=count(*); quantity:f=sum(qty)",
    "FROM mb GROUP BY n, role, cust",
)


def feature_query(name: str, tx: str, cal_sql: str, cols: list[str], where: str = "", label: bool = False, number: bool = True) -> None:
    spec = ["snapshot_no:i"] if number else []
    spec += ["CustomerID:i", "snapshot_date:d", *[f"{c}:f" for c in cols]]
    if label:
        spec.append("inactive_90d:i=inactive")
    add(name, f"{tx},\n{cal_sql},\n{FEATURES}", "; ".join(spec), f"FROM feat {where}")


feature_query("rfm_features", TX, order_cal("oe"), [FEATURE_NAMES[i] for i in (0, 1, 2, 4, 5, 6, 7)])
feature_query("purchase_gaps", TX, order_cal("oe"), ["avg_sale_days", "avg_return_days"])
feature_query("tenure_days", TX, order_cal("oe"), ["tenure_days"])
feature_query("momentum_features", TX, order_cal("oe"), FEATURE_NAMES[10:], "WHERE total_sale_txs > 0")
feature_query("customer_features", TX, order_cal("fe"), FEATURE_NAMES)
feature_query("training_dataset", TX, order_cal("oe"), FEATURE_NAMES, label=True)
feature_query("event_training_dataset", EV, EVENT_CAL, FEATURE_NAMES, label=True)
feature_query("scoring_dataset", TX, ASOF_ORDERS, FEATURE_NAMES, number=False)
feature_query("windowed_scoring", TX, ASOF_ORDERS, FEATURE_NAMES, "WHERE snapshot_date >= TIMESTAMP '2001-07-01'", number=False)
feature_query("event_scoring_dataset", EV, ASOF_EVENTS, FEATURE_NAMES, number=False)

INTERVAL = """pr AS (SELECT DISTINCT cust, invoice, d FROM tx WHERE qty > 0),
gp AS (SELECT cust, date_sub('day', lag(d) OVER (PARTITION BY cust ORDER BY d), d) AS g FROM pr),
av AS (SELECT cust, avg(g) AS a FROM gp GROUP BY cust),
su AS (SELECT quantile_cont(a, [0.1, 0.25, 0.5, 0.75, 0.9]) AS q, count(a) AS r, count(*) AS b FROM av)"""
for _name, _tx in (("purchase_interval_summary", TX), ("event_interval_summary", EV)):
    add(
        _name, f"{_tx}, {INTERVAL}",
        "p10:f=q[1]; p25:f=q[2]; p50:f=q[3]; p75:f=q[4]; p90:f=q[5]; median_months:f=q[3] / 30; repeat_buyers:i=r; buyers:i=b",
        "FROM su",
    )
add(
    "outcome_labels", SCORED,
    "snapshot_date:d; CustomerID:i; outcome_start:t=snapshot_date; outcome_end:t=oe; inactive_90d:i=y",
    "FROM res WHERE prediction_role = 'official'",
)
add(
    "split_dataset", f"{TX},\n{order_cal('oe')},\n{FEATURES}, {ROLL}",
    "snapshot_no:i; CustomerID:i; snapshot_date:d; " + "; ".join(f"{c}:f" for c in FEATURE_NAMES) + "; inactive_90d:i=inactive; split:s",
    "FROM feat JOIN sp ON sp.n = snapshot_no",
)
add(
    "split_summary", f"{TX},\n{order_cal('oe')},\n{FEATURES}, {ROLL}",
    "split:s; snapshot_no:i; rows:i=count(*); label_rate:f=avg(CASE WHEN inactive THEN 1.0 ELSE 0.0 END)",
    "FROM feat JOIN sp ON sp.n = snapshot_no GROUP BY split, snapshot_no",
)
add(
    "group_folds", SCORED,
    "snapshot_no:i=n; CustomerID:i; fold:i=CAST('0x' || substr(md5('42|' || CAST(CustomerID AS VARCHAR)), 1, 8) AS BIGINT) % 3",
    "FROM res WHERE prediction_role = 'official'",
)

# --- drift
add(
    "psi_single", "rw AS (SELECT 'o_totalprice' AS feature, CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 'baseline' ELSE 'current' END AS side, o_totalprice AS v FROM orders)," + psi("rw", "feature"),
    "feature:s; psi:f", "FROM psi",
)
LONG_FEATURES = "lf AS (" + " UNION ALL ".join(f"SELECT snapshot_no, '{c}' AS feature, CAST({c} AS DOUBLE) AS v FROM feat" for c in FEATURE_NAMES) + ")"
DRIFT = (
    f"{TX},\n{order_cal('oe')},\n{FEATURES.replace('feat AS (', 'feat AS MATERIALIZED (')},\n{LONG_FEATURES}" + """,
rw AS (SELECT snapshot_no AS pair, feature, 'current' AS side, v FROM lf WHERE v IS NOT NULL
  UNION ALL SELECT snapshot_no + 1, feature, 'baseline', v FROM lf WHERE v IS NOT NULL),"""
    + psi("rw", "pair, feature")
    + """,
rep AS (SELECT x.pair, x.feature, psi, CASE WHEN x.feature = 'tenure_days' THEN 'expected_temporal' ELSE 'behavioral' END AS drift_type
  FROM (SELECT DISTINCT a.snapshot_no AS pair, a.feature FROM lf a JOIN lf b ON b.snapshot_no = a.snapshot_no - 1 AND a.feature = b.feature) x
  LEFT JOIN psi ON psi.pair = x.pair AND psi.feature = x.feature),
roll AS (SELECT pair, max(psi) AS mx, max(psi) FILTER (drift_type = 'behavioral') AS mb, max(psi) FILTER (feature = 'tenure_days') AS mt FROM rep GROUP BY pair)"""
)
add("feature_drift", DRIFT, "pair:i; feature:s; psi:f; drift_type:s", "FROM rep")
add(
    "top_drift", DRIFT + ", tp AS (SELECT *, row_number() OVER (PARTITION BY pair ORDER BY psi DESC NULLS LAST, feature) AS place FROM rep)",
    "pair:i; feature:s; psi:f; drift_type:s; place:i", "FROM tp WHERE place <= 5",
)
add("drift_rollup", DRIFT, "pair:i; max_feature_psi:f=mx; max_behavioral_feature_psi:f=mb; temporal_psi_tenure_days:f=mt", "FROM roll")
add("behavioral_psi", DRIFT, "pair:i; max_behavioral_feature_psi:f=mb", "FROM roll")


def score_psi(source: str) -> str:
    return f""",
pw AS (SELECT n AS pair, 'current' AS side, p AS v FROM {source} WHERE prediction_role = 'official'
  UNION ALL SELECT n + 1, 'baseline', p FROM {source} WHERE prediction_role = 'official'),""" + psi("pw", "pair")


add(
    "prediction_drift", SCORED + score_psi("pred"),
    "pair:i; prediction_psi:f=psi; status:s=CASE WHEN psi IS NULL THEN 'NOT_AVAILABLE' WHEN psi >= 0.25 THEN 'CRITICAL' WHEN psi >= 0.1 THEN 'WARNING' ELSE 'OK' END",
    "FROM psi",
)

# --- scores and metrics
TIER = "CASE WHEN {0} < 0 OR {0} > 1 THEN NULL WHEN {0} <= 0.3 THEN 'low' WHEN {0} <= 0.6 THEN 'medium' ELSE 'high' END"
KEY = "snapshot_date:d; model_version:s; prediction_role:s"
add(
    "score_projection", SCORED,
    f"CustomerID:i; {KEY}; outcome_start:t=snapshot_date; outcome_end:t=oe; churn_probability:f=p; predicted_churn:i; risk_tier:s={TIER.format('p')}; model_type:s='fixture'; threshold_used:f",
    "FROM pred",
)
add("risk_tiers", "e AS (SELECT event_id, value / 50 AS p FROM events)", f"event_id:i; p:f; tier:s={TIER.format('p')}", "FROM e")
add(
    "scoring_summary", SCORED,
    f"""{KEY}; active_customers:i=count(*); mean_churn_probability:f=avg(p); predicted_churn_rate:f=avg(predicted_churn); threshold:f=max(threshold_used);
    low_risk:i=count(*) FILTER (p <= 0.3); medium_risk:i=count(*) FILTER (p > 0.3 AND p <= 0.6); high_risk:i=count(*) FILTER (p > 0.6)""",
    f"FROM pred GROUP BY {SET}",
)
add(
    "history_summary", RAW + ", cl AS (SELECT DISTINCT * FROM raw WHERE cust IS NOT NULL)",
    "raw_rows:i=(SELECT count(*) FROM raw); clean_rows:i=count(*); history_min:t=min(d); history_max:t=max(d)",
    "FROM cl",
)
add("confusion_matrix", f"{SCORED}, {CLASS}", f"{KEY}; tn:i; fp:i; fn:i; tp:i", "FROM cmm")
add("classification_metrics", f"{SCORED}, {CLASS}", f"{KEY}; accuracy:f=acc; precision:f=prec; recall:f=rcl; f1:f=fone", "FROM cmm")
PROB = "brier_score:f=brier; mean_churn_probability:f=mp; actual_churn_rate:f=rate; predicted_churn_rate:f=prate; calibration_gap:f=mp - rate; mean_threshold_used:f=mt"
add("probability_metrics", f"{SCORED}, {CLASS}", f"{KEY}; {PROB}", "FROM cmm")
add("roc_auc", f"{SCORED}, {RANKED}", f"{KEY}; roc_auc:f=auc", "FROM rk")
add("average_precision", f"{SCORED}, {RANKED}", f"{KEY}; pr_auc:f=ap", "FROM rk")
JOINED = f"FROM cmm JOIN rk USING ({SET})"
FULL = f"accuracy:f=acc; precision:f=prec; recall:f=rcl; f1:f=fone; {PROB}; roc_auc:f=auc; pr_auc:f=ap"
add("model_evaluation", f"{SCORED}, {CLASS}, {RANKED}", f"{KEY}; n:i; tn:i; fp:i; fn:i; tp:i; {FULL}", JOINED)
SWEEP = f"""th AS (SELECT 0.05::DOUBLE + i * 0.05::DOUBLE AS t FROM range(19) r(i)),
sc AS (SELECT {SET}, t, count(*) FILTER (p >= t AND y = 1) AS tp, count(*) FILTER (p >= t AND y = 0) AS fp, sum(y) AS pp, sum(1 - y) AS nn
  FROM res, th GROUP BY ALL),
sw AS (SELECT {SET}, t, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / CAST(tp + fp AS DOUBLE) END AS prec, CASE WHEN pp = 0 THEN 0 ELSE tp / CAST(pp AS DOUBLE) END AS rcl,
  CASE WHEN tp + fp + pp = 0 THEN 0 ELSE 2 * tp / CAST(tp + fp + pp AS DOUBLE) END AS fone, CASE WHEN nn = 0 THEN 0 ELSE fp / CAST(nn AS DOUBLE) END AS fpr FROM sc)"""
add("threshold_sweep", f"{SCORED}, {SWEEP}", f"{KEY}; threshold:f=t; precision:f=prec; recall:f=rcl; f1:f=fone; fpr:f; youden_j:f=rcl - fpr", "FROM sw")
add(
    "best_threshold", f"{SCORED}, {SWEEP}, bt AS (SELECT *, row_number() OVER (PARTITION BY {SET} ORDER BY rcl - fpr DESC, t) AS rn FROM sw)",
    f"{KEY}; best_threshold:f=t; best_value:f=rcl - fpr", "FROM bt WHERE rn = 1",
)
add(
    "calibration_deciles", f"{SCORED}, {CALIB}",
    f"{KEY}; risk_decile:i=dec; n:i; mean_predicted_probability:f=mp; actual_churn_rate:f=rate; absolute_gap:f=gap", "FROM cal10",
)
add("ece", f"{SCORED}, {CALIB}", f"{KEY}; ece:f", "FROM e")

# --- delayed evaluation
add(
    "matured_cohorts", f"""{order_cal('fe')}, {MONTHS},
mm AS (SELECT a, CAST(a - to_months(3) AS DATE) AS s FROM mo),
mr AS (SELECT *, CASE WHEN s < DATE '1996-06-01' THEN 'not_mature' WHEN s NOT IN (SELECT CAST(fe AS DATE) FROM cal) THEN 'no_predictions' END AS r FROM mm)""",
    "as_of:d=a; evaluation_snapshot:d=s; evaluation_skipped:b=r IS NOT NULL; reason:s=r", "FROM mr",
)
add("resolved_predictions", SCORED, f"{KEY}; CustomerID:i; churn_probability:f=p; predicted_churn:i; inactive_90d:i=y", "FROM res")
add("unevaluated_sets", SCORED, KEY, f"FROM (SELECT DISTINCT {SET} FROM pred WHERE snapshot_date >= TIMESTAMP '1999-01-01')")
add("delayed_evaluation", f"{SCORED}, {CLASS}, {RANKED}, {CALIB}", f"{KEY}; n_resolved:i=n; {FULL}; ece:f", f"{JOINED} JOIN e USING ({SET})")
add(
    "delayed_evaluation_stored", f"{SCORED}, {CLASS}, {RANKED}",
    """snapshot_date:d; customers_evaluated:i=n; tn:i; fp:i; fn:i; tp:i; accuracy:f=acc; precision:f=prec; recall:f=rcl; f1:f=fone; brier_score:f=brier;
    mean_churn_probability:f=mp; actual_churn_rate:f=rate; predicted_churn_rate:f=prate; roc_auc:f=auc; pr_auc:f=ap;
    threshold:f=0.5; model_lineage:s='v2'; scoring_run_id:s='run-1'; customers_with_positive_sale:i=tn + fp""",
    f"{JOINED} WHERE prediction_role = 'official'",
)
add(
    "resolved_rollup", f"{SCORED}", "prediction_sets_evaluated:i=count(*); cohorts_evaluated:i=count(DISTINCT snapshot_date)",
    f"FROM (SELECT DISTINCT {SET} FROM res)",
)
PAIRED = f"""{SCORED}, {CLASS}, {RANKED}, al AS (SELECT * {JOINED}),
pa AS (SELECT a.snapshot_date, a.auc AS a1, s.auc AS s1, a.ap AS a2, s.ap AS s2, a.rcl AS a3, s.rcl AS s3, a.brier AS a4, s.brier AS s4
  FROM al a JOIN al s ON a.snapshot_date = s.snapshot_date AND a.prediction_role = 'official' AND s.prediction_role = 'shadow')"""
add(
    "shadow_comparison", PAIRED,
    """snapshot_date:d; official_model_version:s='v2'; shadow_model_version:s='v1';
    official_roc_auc:f=a1; shadow_roc_auc:f=s1; roc_auc_delta_official_minus_shadow:f=a1 - s1;
    official_pr_auc:f=a2; shadow_pr_auc:f=s2; pr_auc_delta_official_minus_shadow:f=a2 - s2;
    official_recall:f=a3; shadow_recall:f=s3; recall_delta_official_minus_shadow:f=a3 - s3;
    official_brier_score:f=a4; shadow_brier_score:f=s4; brier_delta_official_minus_shadow:f=a4 - s4""",
    "FROM pa WHERE snapshot_date NOT IN (SELECT DISTINCT date_trunc('month', o_orderdate) FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01')",
)

# --- governance and lineage
add(
    "promotion_decision", PAIRED + """,
pd AS (SELECT *, coalesce(a1 - s1 >= -0.005, false) AS x, a3 - s3 >= -0.05 AS y, a4 - s4 <= 0.02 AS z FROM pa),
pf AS (SELECT *, concat_ws(',', CASE WHEN NOT x THEN 'roc_auc' END, CASE WHEN NOT y THEN 'recall' END, CASE WHEN NOT z THEN 'brier_score' END) AS f FROM pd)""",
    """snapshot_date:d; challenger_roc_auc:f=a1; challenger_recall:f=a3; challenger_brier_score:f=a4; champion_roc_auc:f=s1; champion_recall:f=s3;
    champion_brier_score:f=s4; primary_delta:f=a1 - s1; recall_delta:f=a3 - s3; brier_delta:f=a4 - s4; primary_pass:b=x; recall_pass:b=y; brier_pass:b=z;
    not_evaluated:b=false; promote:b=x AND y AND z; strict_promote:b=x AND y AND z; failed_checks:s=f;
    reason:s=CASE WHEN x AND y AND z THEN 'promoted' ELSE 'blocked: ' || f END""",
    "FROM pf",
)
for _name in ("reference_metrics", "stored_metrics"):
    add(
        _name, PAIRED + ", pe AS (SELECT *, year(snapshot_date) % 2 = 0 AS ev FROM pa)",
        """snapshot_date:d; reference_source:s=CASE WHEN ev THEN 'test_metrics' ELSE 'metrics' END; reference_roc_auc:f=CASE WHEN ev THEN a1 ELSE s1 END;
        reference_recall:f=CASE WHEN ev THEN a3 ELSE s3 END; reference_brier_score:f=CASE WHEN ev THEN a4 ELSE s4 END""",
        "FROM pe",
    )
SIG = "UNION ALL SELECT snapshot_date, "
ALERTS = f"""al0 AS (WITH {PAIRED} SELECT * FROM pa),
al1 AS (WITH {DRIFT} SELECT pair, mb FROM roll),
al2 AS (WITH {SCORED}{score_psi("res")} SELECT pair, psi FROM psi),
al3 AS (WITH {order_cal("oe")} SELECT n, fe FROM cal),
runs AS (SELECT fe AS snapshot_date, psi, mb, a1, a3, a4, s1, s3, s4, year(fe) % 2 = 0 AS same
  FROM al3 LEFT JOIN al1 ON al1.pair = n LEFT JOIN al2 ON al2.pair = n LEFT JOIN al0 ON al0.snapshot_date = fe),
sg AS (
  SELECT snapshot_date, 'prediction_psi' AS signal, psi AS cur, NULL AS ref, NULL AS reg, psi AS lv, 0.1 AS wl, 0.25 AS cl, 'higher_is_worse' AS dir FROM runs
  {SIG} 'max_behavioral_feature_psi', mb, NULL, NULL, mb, 0.1, 0.25, 'higher_is_worse' FROM runs
  {SIG} 'delayed_roc_auc_regression', a1, s1, s1 - a1, s1 - a1, 0.005, 0.01, 'higher_is_better' FROM runs WHERE a3 IS NOT NULL AND same
  {SIG} 'delayed_recall_regression', a3, s3, s3 - a3, s3 - a3, 0.05, 0.1, 'higher_is_better' FROM runs WHERE a3 IS NOT NULL AND same
  {SIG} 'delayed_brier_worsening', a4, s4, a4 - s4, a4 - s4, 0.02, 0.04, 'lower_is_better' FROM runs WHERE a3 IS NOT NULL AND same
  {SIG} 'delayed_performance_reference', NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM runs WHERE a3 IS NOT NULL AND NOT same),
ss AS (SELECT *, CASE WHEN signal = 'delayed_performance_reference' THEN 'NOT_COMPARABLE' WHEN lv IS NULL THEN 'NOT_AVAILABLE'
  WHEN lv >= cl THEN 'CRITICAL' WHEN lv >= wl THEN 'WARNING' ELSE 'OK' END AS status FROM sg)"""
add(
    "alert_signals", ALERTS,
    "snapshot_date:d; signal:s; status:s; current_value:f=cur; reference_value:f=ref; regression:f=reg; warning_limit:f=wl; critical_limit:f=cl; direction:s=dir",
    "FROM ss",
)
add(
    "alert_rollup", ALERTS,
    """snapshot_date:d; overall_status:s=CASE WHEN count(*) FILTER (status = 'CRITICAL') > 0 THEN 'CRITICAL' WHEN count(*) FILTER (status = 'WARNING') > 0 THEN 'WARNING'
      ELSE max(status) FILTER (signal = 'prediction_psi') END;
    warning_count:i=count(*) FILTER (status = 'WARNING'); critical_count:i=count(*) FILTER (status = 'CRITICAL');
    warning_signals:s=coalesce(string_agg(signal, ',' ORDER BY signal) FILTER (status = 'WARNING'), '');
    critical_signals:s=coalesce(string_agg(signal, ',' ORDER BY signal) FILTER (status = 'CRITICAL'), '')""",
    "FROM ss GROUP BY snapshot_date",
)
FILES = f"""{TX}, {MONTHLY},
fi AS (SELECT month, 'tx_' || strftime(month, '%Y-%m') || '.csv' AS source_file,
  sha256(strftime(month, '%Y-%m-%d') || '|' || CAST(tx_count AS VARCHAR) || '|' || CAST(customer_count AS VARCHAR)) AS sha256,
  CAST(month + to_months(1) AS DATE) AS sd, tx_count AS raw_rows FROM mv),
ma AS (SELECT *, CASE WHEN month(sd) = 7 THEN 'FAILED' ELSE 'SUCCESS' END AS status FROM fi
  WHERE sd <= (SELECT CAST(date_trunc('month', max(o_orderdate)) - to_months(1) AS DATE) FROM orders))"""
FILE_COLS = "sha256:s; snapshot_date:d=sd; source_file:s; raw_rows:i"
add("new_ingestions", FILES, FILE_COLS, "FROM fi WHERE sha256 NOT IN (SELECT sha256 FROM ma WHERE status = 'SUCCESS')")
add(
    "latest_success", FILES,
    FILE_COLS + "; status:s; recorded_at:s=strftime(sd, '%Y-%m-%d') || 'T01:00:00Z'",
    "FROM ma WHERE status = 'SUCCESS'",
)
add("data_through_date", FILES, "data_through_date:s=strftime(max(sd), '%Y-%m-%d')", "FROM ma WHERE status = 'SUCCESS'")
add(
    "latest_execution", SCORED,
    "snapshot_date:d; execution_id:s=strftime(snapshot_date, '%Y%m%d') || 'T120000Z-b'; CustomerID:i; churn_probability:f=p",
    "FROM pred WHERE prediction_role = 'shadow'",
)
add(
    "champion_asof", f"""{TX}, {MONTHLY}, {order_cal("fe")},
pm AS (SELECT month, 'v' || strftime(month, '%Y%m') AS v FROM (SELECT month, tx_count > lag(tx_count) OVER (ORDER BY month) AS g FROM mv) WHERE g),
ca AS (SELECT CAST(fe AS DATE) AS sd, (SELECT max(v) FROM pm WHERE month <= fe) AS v1 FROM cal)""",
    "snapshot_date:d=sd; model_type:s='gbt'; official_version:s=v1; shadow_version:s=(SELECT max(v) FROM pm WHERE v < v1)",
    "FROM ca WHERE v1 IS NOT NULL",
)

# --- stored tables
TEXT_LINE = LINE.replace("Invoice:i", "Invoice:s").replace("StockCode:i", "StockCode:s")
add("csv_scan", TX, TEXT_LINE, "FROM tx")
add("curated_store", TX, LINE, "FROM (SELECT DISTINCT invoice, stock, qty, d, price, cust FROM tx)")
add("compacted_store", TX, LINE, "FROM (SELECT DISTINCT invoice, stock, qty, d, price, cust FROM tx)")
ONCE = TX.replace("tx AS (", "lines AS (", 1) + ",\ntx AS (SELECT DISTINCT * FROM lines)"
add("logged_volumes", f"{ONCE}, {MONTHLY}", "month:d; tx_count:i; customer_count:i; revenue:f", "FROM mv")
add(
    "stored_first_sales", TX, "CustomerID:i=cust; first_sale:t=first",
    "FROM (SELECT cust, min(d) FILTER (qty > 0) AS first FROM tx GROUP BY 1) WHERE first < TIMESTAMP '2000-01-01'",
)
add("deduplicated_stream", TX, TEXT_LINE, "FROM (SELECT DISTINCT invoice, stock, qty, d, price, cust FROM tx)")
add("streamed_store", TX, TEXT_LINE, "FROM (SELECT DISTINCT invoice, stock, qty, d, price, cust FROM tx)")
add(
    "prediction_sink", SCORED,
    f"{KEY}; CustomerID:i; churn_probability:f=p; predicted_churn:i; risk_tier:s={TIER.format('p')}",
    "FROM pred",
)
add(
    "execution_history", SCORED,
    "snapshot_date:d; execution_id:s='20020102T000000Z-b'; CustomerID:i; churn_probability:f=p",
    "FROM pred WHERE prediction_role = 'shadow'",
)
add(
    "file_inventory",
    "ln AS (SELECT sha256(l_orderkey || '|' || l_linenumber || '|' || l_partkey) AS h FROM lineitem)",
    "lines:i=count(*); line_sum:s=CAST(sum(CAST(('0x' || substr(h, 1, 15)) AS UBIGINT)) AS DECIMAL(38, 0))",
    "FROM ln",
)
feature_query("feature_snapshot", TX, order_cal("fe"), FEATURE_NAMES)
add(
    "manifest_log", FILES,
    "source_file:s; sha256:s; snapshot_date:d=sd; status:s; raw_rows:i; recorded_at:s=strftime(sd, '%Y-%m-%d') || 'T01:00:00Z'",
    "FROM ma",
)
add(
    "report_sinks", f"{TX}, {MONTHLY}, fm AS (SELECT unnest(['json', 'csv', 'parquet']) AS format)",
    "month:d; tx_count:i; customer_count:i; revenue:f; format:s", "FROM mv, fm",
)
