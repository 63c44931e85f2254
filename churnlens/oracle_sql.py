"""DuckDB SQL that recomputes each registered query from the same tables.

These strings are the correctness oracle: they run in DuckDB over the
pre-registered views (lineitem, orders, part, customer, nation, ...) and
must give the same rows as the Spark jobs. Shared CTEs are composed from
the pieces below; parameters are formatted in from ``SYNTHETIC_PARAMS``.
"""

from __future__ import annotations

import math

from churnlens.params import SYNTHETIC_PARAMS as P

REF = P.reference_date
START = P.snapshot_start_date
N = P.threshold_days
AS_OF = P.as_of_date
TEST_START = P.test_start_date
MIN_PRECISION = P.min_precision
BINS = P.drift_bins

RAW = """
raw_base AS (
  SELECT
    CASE WHEN o.o_orderkey % 17 <> 0 THEN CAST(o.o_orderkey AS VARCHAR)
         WHEN o.o_orderkey % 2 = 0 THEN concat('C', CAST(o.o_orderkey AS VARCHAR))
         ELSE concat(' c', CAST(o.o_orderkey AS VARCHAR)) END AS "Invoice",
    CAST(l.l_partkey AS VARCHAR) AS "StockCode",
    p.p_name AS "Description",
    CAST(CASE WHEN l.l_returnflag = 'R' AND o.o_orderkey % 5 = 0 THEN -l.l_quantity
              ELSE l.l_quantity END AS BIGINT) AS "Quantity",
    CASE WHEN o.o_orderkey % 97 = 0 THEN NULL
         ELSE o.o_orderdate + to_minutes(CAST(o.o_orderkey % 1440 AS BIGINT)) END AS "InvoiceDate",
    CAST(CASE WHEN l.l_partkey % 101 = 0 THEN 0 ELSE p.p_retailprice END AS DECIMAL(12,2)) AS "Price",
    CASE WHEN o.o_custkey % 4 = 0 THEN NULL ELSE CAST(o.o_custkey AS DOUBLE) END AS "Customer ID",
    n.n_name AS "Country",
    o.o_orderkey AS _k,
    o.o_orderdate AS _od
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey),
raw_tagged AS (
  SELECT * FROM raw_base
  UNION ALL
  SELECT * FROM raw_base WHERE _k % 50 = 0),
raw AS (SELECT * EXCLUDE (_k, _od) FROM raw_tagged)"""

RENAMED = """
renamed AS (
  SELECT "Invoice" AS invoice, "StockCode" AS stock_code, "Description" AS description,
         "Quantity" AS quantity, "InvoiceDate" AS invoice_date, "Price" AS price,
         "Customer ID" AS customer_id, "Country" AS country
  FROM raw),
dist AS (SELECT DISTINCT * FROM renamed),
kept AS (SELECT * FROM dist WHERE customer_id IS NOT NULL AND NOT isnan(customer_id)),
flagged AS (
  SELECT *,
    coalesce(regexp_matches(invoice, '^\\s*[cC]'), false) AS is_cancellation,
    coalesce(quantity <= 0, false) AS has_non_positive_quantity,
    coalesce(price <= 0, false) AS has_non_positive_price,
    invoice_date IS NULL AS has_null_invoice_date,
    coalesce(invoice_date > TIMESTAMP '{ref}', false) AS has_future_invoice_date
  FROM kept),
clean AS (
  SELECT invoice, stock_code, description, quantity, invoice_date, price,
         CAST(CAST(customer_id AS BIGINT) AS VARCHAR) AS customer_id, country,
         is_cancellation, has_non_positive_quantity, has_non_positive_price,
         has_null_invoice_date, has_future_invoice_date
  FROM flagged)""".format(ref=REF)

BASE = "WITH " + RAW + "," + RENAMED


def _guarded_div(num: str, den: str) -> str:
    return (f"CASE WHEN CAST({den} AS DOUBLE) <> 0 THEN CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) "
            f"WHEN CAST({num} AS DOUBLE) > 0 THEN 'inf'::DOUBLE "
            f"WHEN CAST({num} AS DOUBLE) < 0 THEN '-inf'::DOUBLE ELSE 'nan'::DOUBLE END")


def _features_select(t: str, before: str) -> str:
    """Feature aggregates over rows where ``before`` holds, as of ``t``."""
    real = f"({before}) AND NOT is_cancellation"
    total = f"CAST(coalesce(sum(quantity * price) FILTER (WHERE {before}), 0) AS DOUBLE)"
    freq = f"count(DISTINCT invoice) FILTER (WHERE {real})"
    return f"""
    date_sub('day', max(invoice_date) FILTER (WHERE {real}), {t}) AS recency_days,
    {freq} AS frequency,
    {total} AS monetary_total,
    {_guarded_div(total, freq)} AS monetary_avg_order,
    date_sub('day', min(invoice_date) FILTER (WHERE {real}), {t}) AS customer_tenure_days,
    count(DISTINCT stock_code) FILTER (WHERE {real}) AS n_distinct_products,
    {_guarded_div(f"count(*) FILTER (WHERE ({before}) AND has_non_positive_quantity)",
                  f"count(*) FILTER (WHERE {before})")} AS return_rate"""


FEATURES_ASOF = f"""
feat AS (
  SELECT customer_id, {_features_select(f"TIMESTAMP '{AS_OF}'", "invoice_date < TIMESTAMP '" + AS_OF + "'")}
  FROM clean WHERE invoice_date < TIMESTAMP '{AS_OF}'
  GROUP BY customer_id
  HAVING count(*) FILTER (WHERE NOT is_cancellation) > 0)"""

CALENDAR = f"""
mx AS (SELECT max(invoice_date) AS m FROM clean),
cand AS (SELECT unnest(generate_series(TIMESTAMP '{START}', (SELECT m FROM mx), INTERVAL 1 MONTH)) AS snapshot_date),
snaps AS (SELECT snapshot_date FROM cand WHERE snapshot_date <= (SELECT m FROM mx) - INTERVAL {N} DAY)"""

PANEL = f"""
pj AS (
  SELECT c.*, s.snapshot_date AS t FROM clean c JOIN snaps s
  ON c.invoice_date <= s.snapshot_date + INTERVAL {N} DAY),
panel AS (
  SELECT customer_id, t AS snapshot_date, {_features_select("t", "invoice_date < t")},
    NOT coalesce(bool_or(invoice_date > t AND NOT is_cancellation), false) AS is_churned
  FROM pj GROUP BY customer_id, t
  HAVING count(*) FILTER (WHERE invoice_date < t AND NOT is_cancellation) > 0)"""

PER_SNAPSHOT = """
per_snap AS (
  SELECT s.snapshot_date,
         CAST(coalesce(count(p.customer_id), 0) AS BIGINT) AS n_customers,
         CAST(coalesce(count(p.customer_id) FILTER (WHERE p.is_churned), 0) AS BIGINT) AS n_churned
  FROM snaps s LEFT JOIN panel p ON p.snapshot_date = s.snapshot_date
  GROUP BY s.snapshot_date)"""


def _iso(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%dT%H:%M:%S')"


SQL: dict[str, str] = {}

SQL["raw_union_counts"] = BASE + f"""
SELECT CASE WHEN year(_od) < 1998 THEN '{P.expected_parts[0]}' ELSE '{P.expected_parts[1]}' END AS part,
       count(*) AS rows
FROM raw_tagged GROUP BY 1
UNION ALL
SELECT 'total' AS part, count(*) AS rows FROM raw_tagged"""

SQL["raw_quarantine"] = BASE + f"""
SELECT 'kept' AS kind, count(*) AS rows, sum("Quantity")::BIGINT AS quantity FROM raw_tagged
WHERE "StockCode"::BIGINT % 13 <> 0 AND "StockCode"::BIGINT % 17 <> 0
UNION ALL
SELECT 'put aside: ' || CASE WHEN year(_od) < 1998 THEN '{P.expected_parts[0]}' ELSE '{P.expected_parts[1]}' END, count(*), NULL
FROM raw_tagged WHERE "StockCode"::BIGINT % 13 = 0 OR "StockCode"::BIGINT % 17 = 0 GROUP BY 1"""

SQL["append_new_fields"] = BASE + """
SELECT customer_id, invoice, quantity, CASE WHEN NOT is_cancellation THEN country END AS country,
       CASE WHEN NOT is_cancellation THEN invoice_date END AS invoice_date FROM clean"""

SQL["refused_inputs"] = BASE + """
SELECT v.input, v.error, (SELECT count(*) FROM clean) AS rows_held
FROM (VALUES ('unknown mode', 'ValueError'), ('no path', 'KeyError'), ('rows that are no frame', 'TypeError'),
             ('field of another type', 'ValueError'), ('field in another case', 'ValueError')) v(input, error)"""

SQL["raw_rename"] = BASE + "\nSELECT * FROM renamed"
SQL["dedup_exact"] = BASE + "\nSELECT * FROM dist"
SQL["exclude_no_customer"] = BASE + "\nSELECT * FROM kept"
SQL["quality_flags"] = BASE + "\nSELECT * FROM flagged"
SQL["clean_transactions"] = BASE + "\nSELECT * FROM clean"

SQL["validation_report"] = BASE + f"""
SELECT
  (SELECT count(*) FROM renamed) AS source_rows,
  (SELECT count(*) FROM renamed) - (SELECT count(*) FROM dist) AS duplicate_rows_dropped,
  (SELECT count(*) FROM dist) - (SELECT count(*) FROM kept) AS rows_without_customer_id_excluded,
  (SELECT count(*) FROM clean) AS clean_transactions_rows,
  {_iso(f"TIMESTAMP '{REF}'")} AS reference_date_used,
  (SELECT count(*) FILTER (WHERE is_cancellation) FROM clean) AS is_cancellation,
  (SELECT count(*) FILTER (WHERE has_non_positive_quantity) FROM clean) AS has_non_positive_quantity,
  (SELECT count(*) FILTER (WHERE has_non_positive_price) FROM clean) AS has_non_positive_price,
  (SELECT count(*) FILTER (WHERE has_null_invoice_date) FROM clean) AS has_null_invoice_date,
  (SELECT count(*) FILTER (WHERE has_future_invoice_date) FROM clean) AS has_future_invoice_date"""

SQL["customer_features_asof"] = BASE + "," + FEATURES_ASOF + "\nSELECT * FROM feat"

SQL["single_customer_features"] = BASE + f""",
top AS (
  SELECT customer_id FROM clean
  WHERE invoice_date < TIMESTAMP '{AS_OF}' AND NOT is_cancellation
  GROUP BY customer_id ORDER BY count(*) DESC, customer_id LIMIT 1),
one AS (SELECT * FROM clean WHERE customer_id IN (SELECT customer_id FROM top)),
feat1 AS (
  SELECT customer_id, {_features_select(f"TIMESTAMP '{AS_OF}'", "invoice_date < TIMESTAMP '" + AS_OF + "'")}
  FROM one WHERE invoice_date < TIMESTAMP '{AS_OF}'
  GROUP BY customer_id
  HAVING count(*) FILTER (WHERE NOT is_cancellation) > 0)
SELECT * FROM feat1"""

SQL["churn_labels"] = BASE + f"""
SELECT customer_id,
       NOT coalesce(bool_or(invoice_date > TIMESTAMP '{AS_OF}' AND NOT is_cancellation), false) AS is_churned
FROM clean
WHERE invoice_date <= TIMESTAMP '{AS_OF}' + INTERVAL {N} DAY
GROUP BY customer_id
HAVING count(*) FILTER (WHERE invoice_date < TIMESTAMP '{AS_OF}' AND NOT is_cancellation) > 0"""

SQL["snapshot_calendar"] = BASE + "," + CALENDAR + f"""
SELECT snapshot_date, snapshot_date <= (SELECT m FROM mx) - INTERVAL {N} DAY AS is_usable FROM cand"""

SQL["customer_snapshots"] = BASE + "," + CALENDAR + "," + PANEL + "\nSELECT * FROM panel"

SQL["snapshot_report"] = BASE + "," + CALENDAR + "," + PANEL + "," + PER_SNAPSHOT + """
SELECT snapshot_date, n_customers, n_churned,
       CASE WHEN n_customers > 0 THEN n_churned / n_customers ELSE 0.0 END AS churn_rate
FROM per_snap"""

SQL["panel_report_overall"] = BASE + "," + CALENDAR + "," + PANEL + f"""
SELECT CAST({N} AS BIGINT) AS threshold_days,
       {_iso("(SELECT m FROM mx)")} AS max_invoice_date_observed,
       {_iso(f"(SELECT m FROM mx) - INTERVAL {N} DAY")} AS last_labelable_cutoff,
       {_iso(f"TIMESTAMP '{START}'")} AS snapshot_start_date,
       (SELECT count(*) FROM cand) AS candidate_snapshot_dates,
       (SELECT count(*) FROM snaps) AS usable_snapshot_dates,
       (SELECT count(*) FROM panel) AS rows_total,
       CASE WHEN (SELECT count(*) FROM panel) > 0
            THEN (SELECT count(*) FILTER (WHERE is_churned) FROM panel) / (SELECT count(*) FROM panel)
            ELSE 0.0 END AS churn_rate_overall"""

SQL["population_parity"] = BASE + "," + CALENDAR + "," + PANEL + """,
firsts AS (SELECT customer_id, min(invoice_date) AS first_real FROM clean
           WHERE NOT is_cancellation AND invoice_date IS NOT NULL GROUP BY customer_id),
labelled AS (SELECT f.customer_id, s.snapshot_date FROM firsts f JOIN snaps s ON f.first_real < s.snapshot_date),
both_sides AS (
  SELECT coalesce(p.snapshot_date, l.snapshot_date) AS snapshot_date,
         p.customer_id IS NOT NULL AS in_f, l.customer_id IS NOT NULL AS in_l
  FROM panel p FULL OUTER JOIN labelled l
  ON p.customer_id = l.customer_id AND p.snapshot_date = l.snapshot_date)
SELECT s.snapshot_date,
       count(b.snapshot_date) FILTER (WHERE b.in_f) AS n_feature_rows,
       count(b.snapshot_date) FILTER (WHERE b.in_l) AS n_label_rows,
       count(b.snapshot_date) FILTER (WHERE b.in_f AND NOT b.in_l) AS n_only_features,
       count(b.snapshot_date) FILTER (WHERE b.in_l AND NOT b.in_f) AS n_only_labels
FROM snaps s LEFT JOIN both_sides b ON b.snapshot_date = s.snapshot_date
GROUP BY s.snapshot_date"""

SQL["rowcount_check"] = BASE + "," + CALENDAR + "," + PANEL + """
SELECT 'raw_transactions' AS "table", count(*) AS loaded_rows, count(*) AS expected_rows, true AS matches FROM raw
UNION ALL
SELECT 'clean_transactions', count(*), count(*), true FROM clean
UNION ALL
SELECT 'customer_snapshots', count(*), count(*), true FROM panel"""

SQL["table_replace"] = BASE + "\nSELECT * FROM clean"
SQL["table_append"] = BASE + "\nSELECT * FROM clean"

SQL["report_json_roundtrip"] = BASE + "," + CALENDAR + "," + PANEL + "," + PER_SNAPSHOT + f"""
SELECT CAST({N} AS BIGINT) AS threshold_days, (SELECT count(*) FROM panel) AS rows_total,
       {_iso("snapshot_date")} AS snapshot_date, n_customers, n_churned,
       CASE WHEN n_customers > 0 THEN n_churned / n_customers ELSE 0.0 END AS churn_rate
FROM per_snap"""

GAPS = """
pts AS (SELECT DISTINCT customer_id, invoice_date AS ts FROM clean
        WHERE NOT is_cancellation AND invoice_date IS NOT NULL),
gaps AS (SELECT date_sub('day', lag(ts) OVER (PARTITION BY customer_id ORDER BY ts), ts) AS gap_days FROM pts)"""

SQL["purchase_gap_percentile"] = BASE + "," + GAPS + """
SELECT count(gap_days) AS n_gaps,
       quantile_cont(gap_days, 0.5) AS median_gap_days,
       quantile_cont(gap_days, 0.9) AS p90_gap_days,
       avg(gap_days) AS mean_gap_days
FROM gaps"""

SQL["purchase_gap_histogram"] = BASE + "," + GAPS + """
SELECT gap_days, count(*) AS n_gaps FROM gaps WHERE gap_days IS NOT NULL GROUP BY gap_days"""

SQL["favourite_product"] = BASE + f""",
cnt AS (SELECT customer_id, stock_code, count(*) AS n FROM clean
        WHERE NOT is_cancellation AND stock_code IS NOT NULL AND invoice_date < TIMESTAMP '{AS_OF}'
        GROUP BY customer_id, stock_code),
ranked AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY n DESC, stock_code) AS rn FROM cnt)
SELECT customer_id, stock_code AS favourite_stock_code, n AS favourite_lines FROM ranked WHERE rn = 1"""

SPLIT = f"""
sp AS (
  SELECT *, CASE WHEN snapshot_date >= TIMESTAMP '{TEST_START}' THEN 'test'
                 WHEN snapshot_date + INTERVAL {N} DAY <= TIMESTAMP '{TEST_START}' THEN 'train'
                 ELSE 'embargo' END AS split
  FROM panel)"""

PANEL_SPLIT = BASE + "," + CALENDAR + "," + PANEL + "," + SPLIT

SQL["temporal_split_counts"] = PANEL_SPLIT + """
SELECT split, count(*) AS n_rows, count(DISTINCT customer_id) AS n_customers,
       count(DISTINCT snapshot_date) AS n_snapshots,
       count(*) FILTER (WHERE is_churned) AS n_churned,
       CAST(count(*) FILTER (WHERE is_churned) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS churn_rate
FROM sp GROUP BY split"""

CURVE = f""",
scored AS (SELECT is_churned, CAST(recency_days AS DOUBLE) / (CAST(recency_days AS DOUBLE) + {float(N)}) AS score
           FROM sp WHERE split = 'test'),
hist AS (SELECT score, count(*) FILTER (WHERE is_churned) AS pos, count(*) AS n FROM scored GROUP BY score),
cum AS (SELECT score, pos,
               CAST(sum(pos) OVER w AS BIGINT) AS cum_pos, CAST(sum(n) OVER w AS BIGINT) AS cum_n
        FROM hist WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
curve AS (
  SELECT score, pos, cum_pos AS tp, cum_n - cum_pos AS fp,
         CAST(cum_pos AS DOUBLE) / CAST(cum_n AS DOUBLE) AS precision,
         CASE WHEN (SELECT sum(pos) FROM hist) > 0
              THEN CAST(cum_pos AS DOUBLE) / CAST((SELECT sum(pos) FROM hist) AS DOUBLE) ELSE 0.0 END AS recall
  FROM cum)"""

SQL["pr_curve"] = PANEL_SPLIT + CURVE + "\nSELECT * FROM curve"

SQL["recall_at_precision"] = PANEL_SPLIT + CURVE + f"""
SELECT round(CASE WHEN sum(pos) > 0 THEN sum(CAST(pos AS DOUBLE) * precision) / CAST(sum(pos) AS DOUBLE)
                  ELSE 0.0 END, 12) AS average_precision,
       coalesce(max(recall) FILTER (WHERE precision >= {MIN_PRECISION}), 0.0) AS recall_at_precision,
       CAST({MIN_PRECISION} AS DOUBLE) AS min_precision,
       CAST(sum(pos) AS BIGINT) AS n_positive,
       CAST(max(tp + fp) AS BIGINT) AS n_rows
FROM curve"""

_FEATS = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in
                   ["recency_days", "frequency", "monetary_total", "monetary_avg_order",
                    "customer_tenure_days", "n_distinct_products", "return_rate"])
_ON = ", ".join(["recency_days", "frequency", "monetary_total", "monetary_avg_order",
                 "customer_tenure_days", "n_distinct_products", "return_rate"])

LONG = f""",
lf AS (UNPIVOT (SELECT split, {_FEATS} FROM sp) ON {_ON} INTO NAME feature VALUE value),
base AS (SELECT feature, value FROM lf WHERE split = 'train' AND value IS NOT NULL AND isfinite(value)),
cur AS (SELECT feature, value FROM lf WHERE split = 'test' AND value IS NOT NULL AND isfinite(value))"""

SQL["feature_drift_ks"] = PANEL_SPLIT + LONG + """,
allv AS (SELECT feature, value, 1 AS nb, 0 AS nc FROM base UNION ALL SELECT feature, value, 0, 1 FROM cur),
h AS (SELECT feature, value, sum(nb) AS nb, sum(nc) AS nc FROM allv GROUP BY feature, value),
c AS (SELECT feature, sum(nb) OVER w AS cb, sum(nc) OVER w AS cc,
             sum(nb) OVER (PARTITION BY feature) AS tb, sum(nc) OVER (PARTITION BY feature) AS tc
      FROM h WINDOW w AS (PARTITION BY feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT feature, max(abs(CAST(cb AS DOUBLE) / CAST(tb AS DOUBLE) - CAST(cc AS DOUBLE) / CAST(tc AS DOUBLE))) AS ks_statistic,
       CAST(max(tb) AS BIGINT) AS n_baseline, CAST(max(tc) AS BIGINT) AS n_current
FROM c GROUP BY feature"""

SQL["feature_drift_psi"] = PANEL_SPLIT + LONG + f""",
bh AS (SELECT feature, value, count(*) AS n FROM base GROUP BY feature, value),
ch AS (SELECT feature, value, count(*) AS n FROM cur GROUP BY feature, value),
bc AS (SELECT feature, value,
              sum(n) OVER (PARTITION BY feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_n,
              sum(n) OVER (PARTITION BY feature) AS tot
       FROM bh),
qs AS (SELECT unnest(range(1, {BINS})) AS q),
edges AS (SELECT DISTINCT feature, edge FROM (
            SELECT bc.feature, q, min(bc.value) AS edge FROM bc, qs
            WHERE bc.cum_n >= (q * bc.tot + {BINS} - 1) // {BINS} GROUP BY bc.feature, q)),
bbin AS (SELECT h.feature, h.value, h.n, count(e.edge) AS bin FROM bh h
         LEFT JOIN edges e ON e.feature = h.feature AND e.edge < h.value GROUP BY h.feature, h.value, h.n),
cbin AS (SELECT h.feature, h.value, h.n, count(e.edge) AS bin FROM ch h
         LEFT JOIN edges e ON e.feature = h.feature AND e.edge < h.value GROUP BY h.feature, h.value, h.n),
bcount AS (SELECT feature, bin, sum(n) AS nb FROM bbin GROUP BY feature, bin),
ccount AS (SELECT feature, bin, sum(n) AS nc FROM cbin GROUP BY feature, bin),
counts AS (SELECT coalesce(b.feature, c.feature) AS feature, coalesce(b.bin, c.bin) AS bin,
                  coalesce(b.nb, 0) AS nb, coalesce(c.nc, 0) AS nc
           FROM bcount b FULL OUTER JOIN ccount c ON b.feature = c.feature AND b.bin = c.bin),
tots AS (SELECT feature, sum(nb) AS tb, sum(nc) AS tc FROM counts GROUP BY feature),
terms AS (
  SELECT k.feature, t.tb, t.tc,
         CASE WHEN nb = 0 THEN 1e-4 ELSE CAST(nb AS DOUBLE) / CAST(t.tb AS DOUBLE) END AS pb,
         CASE WHEN nc = 0 THEN 1e-4 ELSE CAST(nc AS DOUBLE) / CAST(t.tc AS DOUBLE) END AS pc
  FROM counts k JOIN tots t ON k.feature = t.feature)
SELECT feature, round(sum((pc - pb) * ln(pc / pb)), 9) AS psi, count(*) AS n_bins_used,
       CAST(max(tb) AS BIGINT) AS n_baseline, CAST(max(tc) AS BIGINT) AS n_current
FROM terms GROUP BY feature"""

SQL["confusion_counts"] = PANEL_SPLIT + f""",
scored AS (SELECT is_churned, CAST(recency_days AS DOUBLE) / (CAST(recency_days AS DOUBLE) + {float(N)}) AS score
           FROM sp WHERE split = 'test')
SELECT count(*) FILTER (WHERE score >= 0.5 AND is_churned) AS tp,
       count(*) FILTER (WHERE score >= 0.5 AND NOT is_churned) AS fp,
       count(*) FILTER (WHERE score < 0.5 AND is_churned) AS fn,
       count(*) FILTER (WHERE score < 0.5 AND NOT is_churned) AS tn
FROM scored"""

SQL["customer_snapshots_range"] = SQL["customer_snapshots"]

_UNION_LONG = " UNION ALL ".join(
    f"SELECT split, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM sp" for c in
    ["recency_days", "frequency", "monetary_total", "monetary_avg_order", "customer_tenure_days",
     "n_distinct_products", "return_rate"])

_ALL_LONG = f""",
lfa AS ({_UNION_LONG}),
bsa AS (SELECT feature, value, 'b' AS side FROM lfa WHERE split = 'train'
        UNION ALL SELECT feature, value, 'c' AS side FROM lfa WHERE split = 'test'),
mom AS (
  SELECT feature,
    avg(value) FILTER (WHERE side = 'b' AND value IS NOT NULL AND isfinite(value)) AS mb,
    avg(value) FILTER (WHERE side = 'c' AND value IS NOT NULL AND isfinite(value)) AS mc,
    stddev_samp(value) FILTER (WHERE side = 'b' AND value IS NOT NULL AND isfinite(value)) AS sb,
    stddev_samp(value) FILTER (WHERE side = 'c' AND value IS NOT NULL AND isfinite(value)) AS sc,
    count(*) FILTER (WHERE side = 'b' AND isinf(value)) AS ib, count(*) FILTER (WHERE side = 'c' AND isinf(value)) AS ic,
    CAST(count(*) FILTER (WHERE side = 'b' AND (value IS NULL OR isnan(value))) AS DOUBLE)
      / CAST(count(*) FILTER (WHERE side = 'b') AS DOUBLE) AS nb,
    CAST(count(*) FILTER (WHERE side = 'c' AND (value IS NULL OR isnan(value))) AS DOUBLE)
      / CAST(count(*) FILTER (WHERE side = 'c') AS DOUBLE) AS nc
  FROM bsa GROUP BY feature)"""



def _sig(x: str, digits: int = 10) -> str:
    """Same significant-digit rounding as functions.columns.round_significant."""
    x = f"({x})"
    p = f"pow(10.0, floor(log10(abs({x}))))"
    return (f"CASE WHEN {x} IS NULL OR {x} = 0 OR isnan({x}) THEN {x} "
            f"ELSE round({x} / {p}, {digits - 1}) * {p} END")


SQL["feature_drift_summary"] = PANEL_SPLIT + _ALL_LONG + f"""
SELECT feature, {_sig("mb")} AS mean_baseline, {_sig("mc")} AS mean_current, {_sig("mc - mb")} AS mean_delta,
       {_sig("sb")} AS std_baseline, {_sig("sc")} AS std_current, {_sig("sc - sb")} AS std_delta,
       nb AS null_rate_baseline, nc AS null_rate_current, nc - nb AS null_rate_delta,
       ib AS n_non_finite_baseline, ic AS n_non_finite_current
FROM mom"""

SQL["drift_report"] = f"""
WITH m AS ({SQL['feature_drift_summary']}), k AS ({SQL['feature_drift_ks']}), p AS ({SQL['feature_drift_psi']})
SELECT m.*, k.ks_statistic, k.n_baseline, k.n_current, p.psi, p.n_bins_used
FROM m LEFT JOIN k USING (feature) LEFT JOIN p USING (feature)"""

_FIT = ["true AS probability_in_range", "true AS band_fits"]

SQL["train_and_score"] = PANEL_SPLIT + f"""
SELECT customer_id, snapshot_date, is_churned, {", ".join(_FIT)} FROM sp WHERE split = 'test'"""

SQL["model_evaluation"] = PANEL_SPLIT + f"""
SELECT count(*) AS n_rows, count(*) FILTER (WHERE is_churned) AS n_positive, count(*) AS n_judged,
       count(*) FILTER (WHERE is_churned) AS n_churned, {int(P.model_params["n_estimators"])} AS max_iter,
       CAST({MIN_PRECISION} AS DOUBLE) AS min_precision, true AS average_precision_in_range,
       true AS recall_at_precision_in_range
FROM sp WHERE split = 'test'"""

SQL["shapley_contributions"] = PANEL_SPLIT + """
SELECT customer_id, snapshot_date, true AS adds_up FROM sp WHERE split = 'test'"""

SQL["global_importance"] = PANEL_SPLIT + LONG + """
SELECT DISTINCT feature, true AS not_below_its_mean, true AS ranked FROM lf"""


def _predicted(day: str) -> str:
    """(customer_id, as_of_date, checks) of the population at a date."""
    return f"""SELECT customer_id, TIMESTAMP '{day}' AS as_of_date, {", ".join(_FIT)} FROM clean
WHERE invoice_date < TIMESTAMP '{day}' AND NOT is_cancellation GROUP BY customer_id"""


SQL["batch_predictions"] = BASE + "\n" + _predicted(TEST_START)
SQL["streaming_predictions"] = BASE + "\n" + _predicted(AS_OF) + "\nUNION ALL\n" + _predicted(TEST_START)

# Shapley values of the fixed score: 128 coalitions of each test row, weighted by size.
_NAMES = ["recency_days", "frequency", "monetary_total", "monetary_avg_order", "customer_tenure_days",
          "n_distinct_products", "return_rate"]
_FINITE = ", ".join(f"CASE WHEN {c} IS NULL OR NOT isfinite(CAST({c} AS DOUBLE)) THEN -1.0 ELSE CAST({c} AS DOUBLE) END AS {c}"
                    for c in _NAMES)
_WEIGHTS = [math.factorial(s) * math.factorial(6 - s) / math.factorial(7) for s in range(7)]
_PHI = ",\n".join(
    f"sum(f * CASE WHEN (mask >> {i}) & 1 = 1 THEN list_extract(w, k) ELSE -list_extract(w, k + 1) END) AS phi_{c}"
    for i, c in enumerate(_NAMES))

_SHAPLEY = f""",
finite AS (SELECT split, customer_id, snapshot_date, {_FINITE} FROM sp),
mid AS (SELECT {", ".join(f"avg({c}) AS {c}" for c in _NAMES)} FROM finite WHERE split = 'train'),
mixed AS (SELECT x.customer_id, x.snapshot_date, mask, bit_count(mask) AS k, {[float(w) for w in _WEIGHTS]}::DOUBLE[] AS w,
          {", ".join(f"CASE WHEN (mask >> {i}) & 1 = 1 THEN x.{c} ELSE mid.{c} END AS {c}" for i, c in enumerate(_NAMES))}
          FROM finite x, mid, (SELECT unnest(range(128)) AS mask) WHERE x.split = 'test'),
valued AS (SELECT *, recency_days / (recency_days + 134.0::DOUBLE) * (1.0::DOUBLE - return_rate) * 0.5::DOUBLE
             + 0.3::DOUBLE / (2.0::DOUBLE + frequency) * customer_tenure_days / (customer_tenure_days + 365.0::DOUBLE)
             + 0.1::DOUBLE / (2.0::DOUBLE + n_distinct_products)
             + 0.1::DOUBLE * monetary_avg_order / (abs(monetary_total) + 1000.0::DOUBLE) AS f FROM mixed),
shap AS (SELECT customer_id, snapshot_date, sum(f) FILTER (WHERE mask = 0) AS base_value,
                sum(f) FILTER (WHERE mask = 127) AS prediction, {_PHI}
         FROM valued GROUP BY customer_id, snapshot_date)"""

SQL["shapley_formula"] = PANEL_SPLIT + _SHAPLEY + f"""
SELECT customer_id, snapshot_date, round(base_value, 6) AS base_value, round(prediction, 6) AS prediction,
       {", ".join(f"round(phi_{c}, 6) AS phi_{c}" for c in _NAMES)} FROM shap"""

SQL["importance_formula"] = PANEL_SPLIT + _SHAPLEY + f""",
means AS ({" UNION ALL ".join(f"SELECT '{c}' AS feature, avg(abs(phi_{c})) AS a, avg(phi_{c}) AS m FROM shap" for c in _NAMES)})
SELECT feature, round(a, 6) AS mean_abs_contribution, round(m, 6) AS mean_contribution,
       row_number() OVER (ORDER BY a DESC, feature) AS rank FROM means"""

# the panel kept up to date by increments is the panel
SQL["panel_increments"] = SQL["customer_snapshots"]
SQL["table_replace_month"] = SQL["customer_snapshots"]

# the same report, its sides being two months instead of the split's
_TWO_MONTHS = f"""sp AS (SELECT panel.*, CASE WHEN snapshot_date = TIMESTAMP '{P.as_of_date}' THEN 'train'
                                 WHEN snapshot_date = TIMESTAMP '{P.test_start_date}' THEN 'test' END AS split FROM panel)"""
SQL["drift_between_months"] = SQL["drift_report"].replace(SPLIT.strip(), _TWO_MONTHS)
