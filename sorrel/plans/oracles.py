"""The SQL each query must agree with, written for the tables as given.

Every statement is independent of how the Spark operator works: ranks by window functions, as-of
rows by ASOF JOIN, model scores by long tables, tail probabilities by the log-gamma series.
"""

from __future__ import annotations

from sorrel.functions import fixed
from sorrel.functions.hashing import MULTIPLIER, PRIME
from sorrel.plans import roles as R

AGES = "[" + ", ".join(map(str, fixed.AGES)) + "]"


def listed(values) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


def hashed(cols, seed: int) -> str:
    h = str(seed)
    for c in cols:
        h = f"((({h}) + ({c} % {PRIME})) * {MULTIPLIER}) % {PRIME}"
    return h


def rnd(*cols: str, digits: int = 6) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in cols)


# roles ------------------------------------------------------------------------------------------

INTER = """inter AS (
  SELECT o_custkey AS user_id, l_partkey AS item_id, l_orderkey AS order_id, l_linenumber AS line_no,
         CAST(ceil(l_quantity / 10) AS INT) AS rating, l_shipdate AS ts
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

USERS = f"""people AS (
  SELECT c_custkey AS user_id,
         CASE WHEN c_mktsegment IN ('MACHINERY', 'AUTOMOBILE') THEN 'M'
              WHEN c_mktsegment IN ('HOUSEHOLD', 'FURNITURE') THEN 'F' ELSE 'X' END AS gender,
         CAST(c_mktsegment IN ('MACHINERY', 'AUTOMOBILE') AS INT) AS gender_enc,
         CAST({AGES}[CAST(floor(abs(c_acctbal) / 1500) AS INT) + 1] AS INT) AS age,
         c_nationkey AS occupation
  FROM customer)"""

TAG_COLS = ", ".join(
    f"CAST(list_contains(string_split(p_name, ' '), '{t}') AS INT) AS \"{t}\"" for t in R.TAGS
)
ITEMS = f"""things AS (
  SELECT p_partkey AS item_id, p_name || ' (' || (1950 + p_size) || ')' AS title,
         replace(p_name, ' ', '|') AS genres, CAST(1950 + p_size AS DOUBLE) AS year, {TAG_COLS}
  FROM part)"""

USER_STATS = """ustats AS (
  SELECT user_id, avg(rating) AS user_avg_rating, count(*) AS user_n_ratings,
         coalesce(stddev_samp(rating), 0) AS user_std_rating FROM inter GROUP BY user_id)"""
ITEM_STATS = """istats AS (
  SELECT l_partkey AS item_id, avg(CAST(ceil(l_quantity / 10) AS INT)) AS item_avg_rating, count(*) AS item_n_ratings
  FROM lineitem GROUP BY 1)"""

TAG_LIST = ", ".join(f'"{t}"' for t in R.TAGS)
MATRIX = f"""{INTER}, {USERS}, {ITEMS}, {USER_STATS}, {ITEM_STATS},
matrix AS (
  SELECT i.user_id, i.order_id, i.line_no, i.item_id, i.rating, CAST(i.rating >= 4 AS INT) AS liked,
         coalesce(gender_enc, 0) AS gender_enc, coalesce(age, 0) AS age, coalesce(occupation, 0) AS occupation,
         coalesce(year, 0) AS year, {", ".join(f'coalesce("{t}", 0) AS "{t}"' for t in R.TAGS)},
         user_avg_rating, user_n_ratings, user_std_rating, item_avg_rating, item_n_ratings
  FROM inter i LEFT JOIN people USING (user_id) LEFT JOIN things USING (item_id)
       LEFT JOIN ustats USING (user_id) LEFT JOIN istats USING (item_id))"""

SPLIT_TEST = f"{hashed(R.ROW_KEY, 42)} < {int(0.2 * 2**31)}"
FOLD = f"CAST(({hashed(R.ROW_KEY, 7)}) % 5 AS INT)"
PARTS = f"""{MATRIX},
parts AS MATERIALIZED (
  SELECT *, row_number() OVER () AS rid, CASE WHEN {SPLIT_TEST} THEN 'test' ELSE 'train' END AS split, {FOLD} AS fold FROM matrix)"""

CONT_CAST = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in R.CONTINUOUS)
LONG = f"""{PARTS},
cont AS MATERIALIZED (
  UNPIVOT (SELECT rid, split, fold, liked, {CONT_CAST} FROM parts) ON {", ".join(R.CONTINUOUS)} INTO NAME feature VALUE x),
bin AS MATERIALIZED (
  UNPIVOT (SELECT rid, split, fold, liked, {TAG_LIST} FROM parts) ON {TAG_LIST} INTO NAME feature VALUE x)"""

# one model: the runs table holds its settings, held the fold left out (-1: none)
RUN_ROWS = ", ".join(f"({i}, '{n}', {s}, {a}, {g}, {b})" for i, (n, s, a, g, b) in enumerate(fixed.RUNS))


def models(runs: str, held: str) -> str:
    return f"""{LONG},
runs(run_order, run, smoothing, alpha, wg, wb) AS (VALUES {runs}),
held(h) AS (VALUES {held}),
span AS (
  SELECT h, feature, min(x) AS lo, max(x) AS hi, CASE WHEN max(x) = min(x) THEN 1 ELSE max(x) - min(x) END AS w
  FROM cont, held WHERE split = 'train' AND fold <> h GROUP BY ALL),
scaled AS (
  SELECT h, c.feature, liked, (x - lo) / w AS s FROM cont c JOIN span USING (feature) WHERE split = 'train' AND fold <> h),
whole AS (SELECT h, max(v) AS v FROM (SELECT h, feature, var_pop(s) AS v FROM scaled GROUP BY ALL) GROUP BY h),
gauss AS (
  SELECT h, feature, avg(s) FILTER (liked = 0) AS m0, avg(s) FILTER (liked = 1) AS m1,
         var_pop(s) FILTER (liked = 0) AS v0, var_pop(s) FILTER (liked = 1) AS v1 FROM scaled GROUP BY ALL),
ones AS (
  SELECT h, feature, count(*) FILTER (liked = 0) AS n0, count(*) FILTER (liked = 1) AS n1,
         count(*) FILTER (liked = 0 AND x > 0) AS c0, count(*) FILTER (liked = 1 AND x > 0) AS c1
  FROM bin, held WHERE split = 'train' AND fold <> h GROUP BY ALL),
prior AS (
  SELECT h, avg(CAST(liked = 0 AS DOUBLE)) AS p0, avg(CAST(liked = 1 AS DOUBLE)) AS p1
  FROM parts, held WHERE split = 'train' AND fold <> h GROUP BY h),
gparams AS (
  SELECT run, h, g.feature, lo, hi, w, m0, m1, v0 + smoothing * v AS v0, v1 + smoothing * v AS v1
  FROM runs, gauss g JOIN whole USING (h) JOIN span USING (h, feature)),
bparams AS (
  SELECT run, h, feature, (c0 + alpha) / (n0 + 2 * alpha) AS q0, (c1 + alpha) / (n1 + 2 * alpha) AS q1 FROM runs, ones)"""


ONE_MODEL = models(RUN_ROWS.split("), ")[0] + ")", "(-1)")

SCORED = f"""{ONE_MODEL},
glog AS (
  SELECT rid, sum(-0.5 * ln(v1) - ((x - lo) / w - m1) ** 2 / (2 * v1) + 0.5 * ln(v0) + ((x - lo) / w - m0) ** 2 / (2 * v0)) AS g
  FROM cont JOIN gparams USING (feature) GROUP BY rid),
blog AS (
  SELECT rid, sum(CASE WHEN x > 0 THEN ln(q1 / q0) ELSE ln((1 - q1) / (1 - q0)) END) AS b
  FROM bin JOIN bparams USING (feature) GROUP BY rid),
scored_all AS MATERIALIZED (
  SELECT p.*, (0.6 / (1 + exp(-(g + ln(p1 / p0)))) + 0.4 / (1 + exp(-(b + ln(p1 / p0))))) / (0.6 + 0.4) AS score
  FROM parts p JOIN glog USING (rid) JOIN blog USING (rid), prior),
scored AS (
  SELECT order_id, line_no, item_id, user_id, liked AS label, score, CAST(score >= 0.5 AS INT) AS pred, {TAG_LIST}
  FROM scored_all WHERE split = 'test')"""

CONFUSION = """cm AS (
  SELECT count(*) FILTER (label = 0 AND pred = 0) AS tn, count(*) FILTER (label = 0 AND pred = 1) AS fp,
         count(*) FILTER (label = 1 AND pred = 0) AS fn, count(*) FILTER (label = 1 AND pred = 1) AS tp FROM scored)"""


def auc(source: str, group: str = "") -> str:
    """Mann-Whitney form with average ranks."""
    by = f"PARTITION BY {group}" if group else ""
    sel = f"{group}, " if group else ""
    tail = f"GROUP BY {group}" if group else ""
    return f"""SELECT {sel}(sum(r) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2.0)
         / (count(*) FILTER (label = 1) * CAST(count(*) FILTER (label = 0) AS DOUBLE)) AS roc_auc
  FROM (SELECT {sel}label, rank() OVER ({by} ORDER BY score) + (count(*) OVER (PARTITION BY {sel}score) - 1) / 2.0 AS r FROM {source}) {tail}"""


# drift ------------------------------------------------------------------------------------------

SIDES = f"""both_sides AS (
  SELECT l_shipdate < TIMESTAMP '{R.CUT}' AS is_ref, l_quantity, l_extendedprice, l_discount,
         CASE WHEN l_shipdate < TIMESTAMP '{R.CUT}' THEN l_tax * 1.0 ELSE l_tax * 1.5 END AS l_tax,
         CAST(l_returnflag = 'R' AS DOUBLE) AS returned, CAST(l_linestatus = 'O' AS DOUBLE) AS is_open FROM lineitem),
vals AS MATERIALIZED (UNPIVOT both_sides ON {", ".join(R.DRIFT_COLUMNS)} INTO NAME feature VALUE v)"""


def psi_ctes(values: str, key: str) -> str:
    """PSI of `values`(key, is_ref, v) over equal-width bins of the joint range."""
    return f"""psi_span AS (
  SELECT {key}, min(v) AS lo, max(v) AS hi, count(*) FILTER (is_ref) AS rn, count(*) FILTER (NOT is_ref) AS cn FROM {values} GROUP BY {key}),
psi_bins AS (
  SELECT {key}, b, lo, hi, rn, cn, b * ((hi - lo) / 10.0) + lo AS e0, (b + 1) * ((hi - lo) / 10.0) + lo AS e1
  FROM psi_span, range(10) t(b)),
psi_counts AS (
  SELECT p.{key}, p.b, any_value(lo) AS lo, any_value(hi) AS hi, any_value(rn) AS rn, any_value(cn) AS cn,
         count(v) FILTER (is_ref) AS r, count(v) FILTER (NOT is_ref) AS c
  FROM psi_bins p LEFT JOIN {values} x ON x.{key} = p.{key} AND (b = 0 OR v >= e0) AND (b = 9 OR v < e1) GROUP BY ALL),
psi_shares AS (
  SELECT {key}, lo, hi, CASE WHEN r = 0 THEN 0.001 ELSE r / rn END AS rs, CASE WHEN c = 0 THEN 0.001 ELSE c / cn END AS cs FROM psi_counts),
psi AS (
  SELECT {key}, CASE WHEN any_value(lo) = any_value(hi) THEN 0.0 ELSE round(abs(sum((cs - rs) * ln(cs / rs))), 6) END AS psi
  FROM psi_shares GROUP BY {key})"""


KS = """ks_counts AS (
  SELECT feature, v, count(*) FILTER (is_ref) AS r, count(*) FILTER (NOT is_ref) AS c FROM vals GROUP BY ALL),
ks_ecdf AS (
  SELECT feature, v, sum(r) OVER w / sum(r) OVER g AS f1, sum(c) OVER w / sum(c) OVER g AS f2,
         lead(v) OVER w AS nxt, sum(r) OVER g AS n, sum(c) OVER g AS m
  FROM ks_counts WINDOW w AS (PARTITION BY feature ORDER BY v), g AS (PARTITION BY feature)),
ks_stat AS (
  SELECT feature, max(abs(f1 - f2)) AS ks, sum(abs(f1 - f2) * coalesce(nxt - v, 0)) AS wasserstein,
         max(abs(f1 - f2)) * sqrt(CAST(max(n) AS DOUBLE) * max(m) / (max(n) + max(m))) AS lam
  FROM ks_ecdf GROUP BY feature),
ks AS (
  SELECT feature, ks, wasserstein, CASE WHEN lam < 0.2 THEN 1.0 ELSE greatest(0.0, least(1.0,
         2 * list_sum(list_transform(range(1, 101), lambda k: (CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END) * exp(-2.0 * k * k * lam * lam))))) END AS p_value
  FROM ks_stat)"""


def chi2_tail(stat: str, dof: str) -> str:
    """Upper tail by the series of the lower incomplete gamma function."""
    return f"""CASE WHEN {stat} <= 0 THEN 1.0 ELSE greatest(0.0, 1 - list_sum(list_transform(range(0, 600),
      lambda n: exp(-{stat} / 2 + ({dof} / 2.0 + n) * ln({stat} / 2) - lgamma({dof} / 2.0 + n + 1))))) END"""


def chi2_ctes(counts: str) -> str:
    """Chi-squared of `counts`(feature, category, r, c)."""
    return f"""chi_tot AS (SELECT feature, sum(r) AS rn, sum(c) AS cn FROM {counts} GROUP BY feature),
chi_stat AS (
  SELECT feature, sum(CASE WHEN r > 0 THEN (c - r * cn / rn) ** 2 / (r * cn / rn) END) AS chi, count(*) FILTER (r > 0) AS k,
         CAST(coalesce(sum(c) FILTER (r = 0), 0) AS BIGINT) AS unseen_count
  FROM {counts} JOIN chi_tot USING (feature) GROUP BY feature),
chi AS (
  SELECT feature, CASE WHEN k < 2 THEN 0.0 ELSE chi END AS statistic, k - 1 AS dof, unseen_count,
         CASE WHEN k < 2 THEN 1.0 ELSE {chi2_tail("chi", "(k - 1)")} END AS p_value FROM chi_stat)"""


FEATURE_DRIFT = f"""{SIDES}, {psi_ctes("vals", "feature")}, {KS},
bin_counts AS (
  SELECT feature, CAST(v AS BIGINT) AS category, count(*) FILTER (is_ref) AS r, count(*) FILTER (NOT is_ref) AS c
  FROM vals WHERE feature IN ('returned', 'is_open') GROUP BY ALL),
{chi2_ctes("bin_counts")},
moments AS (
  SELECT feature, avg(v) FILTER (is_ref) AS ref_mean, avg(v) FILTER (NOT is_ref) AS cur_mean,
         stddev_pop(v) FILTER (is_ref) AS ref_std, stddev_pop(v) FILTER (NOT is_ref) AS cur_std FROM vals GROUP BY feature),
drift AS (
  SELECT feature, psi, CASE WHEN chi.feature IS NULL THEN 'ks' ELSE 'chi2' END AS test,
         round(coalesce(statistic, ks), 6) AS statistic, round(coalesce(chi.p_value, ks.p_value), 6) AS p_value,
         CASE WHEN chi.feature IS NULL THEN round(wasserstein, 6) END AS wasserstein,
         coalesce(chi.p_value, ks.p_value) < 0.05 OR psi > 0.25 AS drifted,
         {rnd("ref_mean", "cur_mean", "ref_std", "cur_std", digits=4)}, round(abs(cur_mean - ref_mean), 4) AS mean_shift,
         coalesce(unseen_count, 0) AS unseen_count
  FROM psi JOIN ks USING (feature) JOIN moments USING (feature) LEFT JOIN chi USING (feature))"""

SUMMARY = f"""{FEATURE_DRIFT},
summary AS (
  SELECT round(avg(psi), 6) AS global_psi, count(*) AS n_features, count(*) FILTER (drifted) AS n_drifted,
         round(count(*) FILTER (drifted) / count(*), 4) AS drift_ratio,
         coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (drifted), '') AS drifted_features,
         CASE WHEN avg(psi) < 0.1 THEN 'green' WHEN avg(psi) < 0.25 THEN 'orange' ELSE 'red' END AS severity,
         avg(psi) > 0.25 AS retrain_needed FROM drift)"""

# monitoring -------------------------------------------------------------------------------------

SCORES = f"""score_log AS (
  SELECT event_id, ts, strftime(ts, '%Y-%m-%d') AS batch_id, value AS latency_ms,
         ts < TIMESTAMP '{R.EVENT_CUT}' AS is_ref, value * CASE WHEN ts >= TIMESTAMP '{R.EVENT_CUT}' THEN 2.0 ELSE 1.0 END AS w,
         w / (w + 50.0) AS score FROM events)"""

SCORE_STATS = """count(*) AS n, round(avg(score), 4) AS mean, round(stddev_pop(score), 4) AS std, round(min(score), 4) AS min,
  round(max(score), 4) AS max, round(quantile_cont(score, 0.25), 4) AS p25, round(quantile_cont(score, 0.5), 4) AS p50,
  round(quantile_cont(score, 0.75), 4) AS p75, round(avg(CAST(score >= 0.5 AS DOUBLE)), 4) AS positive_rate"""

BATCHES = f"""{SCORES},
days AS (SELECT DISTINCT batch_id FROM score_log WHERE NOT is_ref),
pool AS MATERIALIZED (
  SELECT batch_id, false AS is_ref, score AS v FROM score_log WHERE NOT is_ref
  UNION ALL SELECT d.batch_id, true, s.score FROM score_log s, days d WHERE s.is_ref),
{psi_ctes("pool", "batch_id")},
batches AS MATERIALIZED (
  SELECT batch_id, {SCORE_STATS}, any_value(psi) AS psi, quantile_cont(latency_ms, 0.5) AS lat_p50,
         quantile_cont(latency_ms, 0.95) AS lat_p95, quantile_cont(latency_ms, 0.99) AS lat_p99, avg(latency_ms) AS lat_mean
  FROM score_log JOIN psi USING (batch_id) WHERE NOT is_ref GROUP BY batch_id),
ref_rate AS (SELECT round(avg(CAST(score >= 0.5 AS DOUBLE)), 4) AS rate FROM score_log WHERE is_ref),
pred AS (
  SELECT count(*) AS n_batches, CAST(sum(n) AS BIGINT) AS total_predictions, avg(psi) AS psi, max(psi) AS worst,
         avg(positive_rate) AS rate, sum(positive_rate * n) / sum(n) AS weighted,
         abs(avg(positive_rate) - (SELECT rate FROM ref_rate)) AS shift, avg(lat_p50) AS lat_p50, avg(lat_p95) AS lat_p95,
         avg(lat_p99) AS lat_p99, max(lat_p99) AS lat_max_p99 FROM batches)"""

STAMP = "strftime({0}, '%Y-%m-%d %H:%M:%S')"


def stamp(c: str) -> str:
    return STAMP.format(c)


LOG = "log AS (SELECT event_id, ts, event_type AS endpoint, CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status, value AS latency_ms FROM events)"
FINAL = "window_end <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events) AS final"


def middle(v: str) -> str:
    """Middle of the value's log-linear bin: 64 bins between neighbouring powers of two."""
    size = f"abs({v})"
    e = f"(floor(log2({size})) + CASE WHEN pow(2, floor(log2({size}))) > {size} THEN -1 WHEN pow(2, floor(log2({size})) + 1) <= {size} THEN 1 ELSE 0 END)"
    return f"(CASE WHEN {v} = 0 THEN 0.0 ELSE sign({v}) * pow(2, {e}) * (1 + (floor(({size} / pow(2, {e}) - 1) * 64) + 0.5) / 64) END)"


def latency_breach(value: str) -> str:
    return f"""WITH {LOG},
steps AS (SELECT date_trunc('hour', ts) AS h, quantile_disc({value}, 0.99) AS p99 FROM log GROUP BY 1),
hold AS (SELECT h - k * INTERVAL 1 HOUR AS window_start, p99 FROM steps, range(3) t(k)),
wins AS (
  SELECT window_start, window_start + INTERVAL 3 HOUR AS window_end, max(p99) AS value FROM hold
  GROUP BY 1 HAVING count(*) FILTER (p99 > 200) = 3)
SELECT {stamp("window_start")} AS window_start, {stamp("window_end")} AS window_end, 'high_latency' AS type,
       'warning' AS severity, round(value, 6) AS value, {FINAL} FROM wins"""


ERROR_RATE = f"""WITH {LOG},
slid AS (
  SELECT date_trunc('hour', ts) - k * INTERVAL 1 HOUR + INTERVAL 1 HOUR AS checked, count(*) FILTER (status >= 500) / 7200.0 AS rate
  FROM log, range(2) t(k) GROUP BY 1),
hold AS (SELECT checked - k * INTERVAL 1 HOUR AS window_start, rate FROM slid, range(2) t(k)),
wins AS (
  SELECT window_start, window_start + INTERVAL 2 HOUR AS window_end, max(rate) AS value FROM hold
  GROUP BY 1 HAVING count(*) FILTER (rate > 0.0004) = 2)
SELECT {stamp("window_start")} AS window_start, {stamp("window_end")} AS window_end, 'high_error_rate' AS type,
       'critical' AS severity, round(value, 6) AS value, {FINAL} FROM wins"""

SILENCE = f"""WITH {LOG}, g AS (SELECT endpoint AS target, ts, lead(ts) OVER (PARTITION BY endpoint ORDER BY ts) AS nxt FROM log)
      SELECT target, {stamp("ts + INTERVAL 1 HOUR")} AS silent_from, {stamp("nxt")} AS back_at, 'target_down' AS type, 'critical' AS severity
      FROM g WHERE coalesce(nxt, (SELECT max(ts) FROM log)) - ts > INTERVAL 1 HOUR"""


# store ------------------------------------------------------------------------------------------

DAILY = """daily AS (
  SELECT user_id, date_trunc('day', ts) + INTERVAL 1 DAY AS known, avg(value) AS mean_value, count(*) AS n_events
  FROM events GROUP BY 1, 2)"""


def latest_daily(start: str, end: str, name: str) -> str:
    return f"""{name} AS (
  SELECT user_id, known, mean_value, CAST(n_events AS DOUBLE) AS n_events FROM daily
  WHERE known BETWEEN TIMESTAMP '{start}' AND TIMESTAMP '{end}' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY known DESC) = 1)"""


SERVED = f"""{ONE_MODEL},
side_u AS (
  SELECT user_id, CAST(gender_enc AS DOUBLE) AS gender_enc, CAST(age AS DOUBLE) AS age, CAST(occupation AS DOUBLE) AS occupation,
         coalesce(nullif(user_avg_rating, 0), 3.5) AS user_avg_rating, CAST(coalesce(nullif(user_n_ratings, 0), 20) AS DOUBLE) AS user_n_ratings,
         coalesce(nullif(user_std_rating, 0), 1.0) AS user_std_rating FROM people LEFT JOIN ustats USING (user_id)),
mean_u AS (
  SELECT user_id, CAST(gender_enc AS DOUBLE) AS gender_enc, CAST(age AS DOUBLE) AS age, CAST(occupation AS DOUBLE) AS occupation,
         coalesce(user_avg_rating, (SELECT avg(user_avg_rating) FROM ustats)) AS user_avg_rating,
         CAST(coalesce(user_n_ratings, (SELECT avg(user_n_ratings) FROM ustats)) AS DOUBLE) AS user_n_ratings,
         coalesce(user_std_rating, (SELECT avg(user_std_rating) FROM ustats)) AS user_std_rating FROM people LEFT JOIN ustats USING (user_id)),
side_i AS (
  SELECT item_id, year, coalesce(item_avg_rating, 3.5) AS item_avg_rating, CAST(coalesce(item_n_ratings, 10) AS DOUBLE) AS item_n_ratings,
         {TAG_LIST} FROM things LEFT JOIN istats USING (item_id))"""


def glogit(source: str, key: str, cols) -> str:
    return f"""SELECT {key}, sum(-0.5 * ln(v1) - ((x - lo) / w - m1) ** 2 / (2 * v1) + 0.5 * ln(v0) + ((x - lo) / w - m0) ** 2 / (2 * v0)) AS g
  FROM (UNPIVOT (SELECT {key}, {", ".join(cols)} FROM {source}) ON {", ".join(cols)} INTO NAME feature VALUE x) JOIN gparams USING (feature) GROUP BY {key}"""


ITEM_B = f"""SELECT item_id, sum(CASE WHEN x > 0 THEN ln(q1 / q0) ELSE ln((1 - q1) / (1 - q0)) END) AS d
  FROM (UNPIVOT (SELECT item_id, {TAG_LIST} FROM side_i) ON {TAG_LIST} INTO NAME feature VALUE x) JOIN bparams USING (feature) GROUP BY item_id"""


def recommended(users: str, k: int, excluded: str) -> str:
    return f"""WITH {SERVED},
up AS ({glogit(users, "user_id", R.USER_SIDE)}),
ip AS (SELECT item_id, round(g, 9) AS b, round(d, 9) AS d FROM ({glogit("side_i", "item_id", R.ITEM_SIDE[:3])}) JOIN ({ITEM_B}) USING (item_id)),
pairs AS (
  SELECT user_id, item_id, b, (0.6 / (1 + exp(-(g + b + ln(p1 / p0)))) + 0.4 / (1 + exp(-(d + ln(p1 / p0))))) / (0.6 + 0.4) AS score
  FROM up, ip, prior {excluded}),
ranked AS (
  SELECT user_id, item_id, score, CAST(row_number() OVER (PARTITION BY user_id ORDER BY round(score, 6) DESC, b DESC, item_id) AS INT) AS rank FROM pairs)
SELECT user_id, rank, item_id, round(score, 6) AS score FROM ranked WHERE rank <= {k}"""


SPLIT_COLS = "order_id, line_no, item_id, user_id"
ORDER_LABELS = f"ord AS (SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INT) AS label, {hashed(['o_orderkey'], 42)} AS h FROM orders)"
RANKED_ORDERS = f"""{ORDER_LABELS},
rk AS (SELECT o_orderkey, label, row_number() OVER (PARTITION BY label ORDER BY h, o_orderkey) - 1 AS r, count(*) OVER (PARTITION BY label) AS n FROM ord)"""

ERRORS_USERS = [
    ("id", "user_id <= 0"),
    ("gender", "gender NOT IN ('M', 'F')"),
    ("age", f"age NOT IN ({listed(fixed.AGES)})"),
    ("occupation", f"occupation NOT IN ({listed(fixed.OCCUPATIONS)})"),
]
ERRORS_ITEMS = [
    ("id", "item_id <= 0"),
    ("title", "length(title) = 0"),
    ("tags", f"len(list_filter(string_split(genres, '|'), lambda t: NOT list_contains([{listed(R.TAGS[:14])}], t))) > 0"),
]


def errors(rules) -> str:
    first = "CASE " + " ".join(f"WHEN {bad} THEN '{m}'" for m, bad in rules) + " END AS error"
    every = "concat_ws(',', " + ", ".join(f"CASE WHEN {bad} THEN '{m}' END" for m, bad in rules) + ") AS errors"
    return f"{first}, {every}"


CV_HITS = """glog AS (
  SELECT run, h, rid, sum(-0.5 * ln(v1) - ((x - lo) / w - m1) ** 2 / (2 * v1) + 0.5 * ln(v0) + ((x - lo) / w - m0) ** 2 / (2 * v0)) AS g
  FROM cont JOIN gparams USING (feature) WHERE (h >= 0 AND fold = h AND split = 'train') OR (h < 0 AND split = 'test') GROUP BY ALL),
blog AS (
  SELECT run, h, rid, sum(CASE WHEN x > 0 THEN ln(q1 / q0) ELSE ln((1 - q1) / (1 - q0)) END) AS b
  FROM bin JOIN bparams USING (feature) WHERE (h >= 0 AND fold = h AND split = 'train') OR (h < 0 AND split = 'test') GROUP BY ALL),
run_scores AS MATERIALIZED (
  SELECT run_order, run, h, liked AS label, (wg / (1 + exp(-(g + ln(p1 / p0)))) + wb / (1 + exp(-(b + ln(p1 / p0))))) / (wg + wb) AS score
  FROM glog JOIN blog USING (run, h, rid) JOIN prior USING (h) JOIN runs USING (run) JOIN parts USING (rid)),
hits AS (SELECT run, h AS fold, avg(CAST((score >= 0.5) = (label = 1) AS DOUBLE)) AS accuracy FROM run_scores WHERE h >= 0 GROUP BY ALL)"""

FOLDS = "(0), (1), (2), (3), (4)"
GRID = f"""{models(RUN_ROWS, FOLDS + ", (-1)")}, {CV_HITS},
cvs AS (SELECT run, round(avg(accuracy), 4) AS cv_mean, round(stddev_pop(accuracy), 4) AS cv_std FROM hits GROUP BY run),
test AS (SELECT run_order, run, label, score, CAST(score >= 0.5 AS INT) AS pred FROM run_scores WHERE h < 0),
counts AS (
  SELECT run_order, run, count(*) FILTER (label = 1 AND pred = 1) AS tp, count(*) FILTER (label = 0 AND pred = 1) AS fp,
         count(*) FILTER (label = 1 AND pred = 0) AS fn, count(*) AS n, count(*) FILTER (label = pred) AS good FROM test GROUP BY ALL),
aucs AS ({auc("test", "run")}),
grid AS (
  SELECT run, CAST(run_order AS INT) AS run_order, round(good / n, 4) AS accuracy,
         CASE WHEN tp + fp = 0 THEN 0 ELSE round(tp / (tp + fp), 4) END AS "precision", round(tp / (tp + fn), 4) AS recall,
         round(2 * tp / (2 * tp + fp + fn), 4) AS f1_score, round(roc_auc, 4) AS roc_auc, cv_mean, cv_std
  FROM counts JOIN aucs USING (run) JOIN cvs USING (run))"""

RANGE_DAYS = "ts BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-12'"

GATE_SQL = f"""WITH {SCORED}, {CONFUSION}, a AS ({auc("scored")}),
      folds AS (WITH {models(RUN_ROWS.split("), ")[0] + ")", FOLDS)}, {CV_HITS} SELECT round(stddev_pop(accuracy), 4) AS cv_std FROM hits),
      s AS (SELECT split, avg(CAST((score >= 0.5) = (liked = 1) AS DOUBLE)) AS acc FROM scored_all GROUP BY split),
      v AS (SELECT 'accuracy' AS metric, '>=' AS comparison, 0.6 AS "limit", round((tp + tn) / (tp + tn + fp + fn), 4) AS value FROM cm
        UNION ALL SELECT 'f1_score', '>=', 0.5, round(2 * tp / (2 * tp + fp + fn), 4) FROM cm
        UNION ALL SELECT 'roc_auc', '>=', 0.52, round(roc_auc, 4) FROM a
        UNION ALL SELECT 'cv_std', '<=', 0.05, cv_std FROM folds
        UNION ALL SELECT 'separation', '>=', 0.005, round(avg(score) FILTER (label = 1) - avg(score) FILTER (label = 0), 6) FROM scored
        UNION ALL SELECT 'train_test_gap', '<=', 0.2, round(abs(max(acc) - min(acc)), 6) FROM s)
      SELECT metric, comparison, CAST("limit" AS DOUBLE) AS "limit", value, CASE WHEN comparison = '>=' THEN value >= "limit" ELSE value <= "limit" END AS passed FROM v"""

TRAINING_RUN = f"""WITH g AS ({GATE_SQL}), {PARTS}
  SELECT 'rule' AS kind, metric AS name, CASE WHEN passed THEN 'passed' ELSE 'failed' END AS status, value FROM g
  UNION ALL SELECT 'run', 'run', CASE WHEN bool_and(passed) THEN 'promoted' ELSE 'rejected' END, CAST(count(*) FILTER (passed) AS DOUBLE) FROM g
  UNION ALL SELECT 'stage', name, 'done', CAST(n AS DOUBLE) FROM (
    SELECT 'prepare' AS name, count(*) AS n FROM parts UNION ALL SELECT 'score', count(*) FROM parts
    UNION ALL SELECT 'fit', 2 + {len(R.CONTINUOUS) + len(R.TAGS)} UNION ALL SELECT 'cross_validate', count(DISTINCT fold) FROM parts WHERE split = 'train'
    UNION ALL SELECT 'evaluate', count(*) + len(['precision', 'recall', 'cv_mean']) FROM g UNION ALL SELECT 'judge', count(*) FROM g)"""


ORACLES: dict[str, str] = {
    "one_hot_tags": f"WITH {ITEMS} SELECT item_id, {TAG_LIST} FROM things",
    "explode_tokens": f"WITH {ITEMS} SELECT item_id, unnest(string_split(genres, '|')) AS token FROM things",
    "extract_year": f"WITH {ITEMS} SELECT item_id, title, CAST(regexp_extract(title, '\\((\\d{{4}})\\)', 1) AS DOUBLE) AS year FROM things",
    "encode_binary": f"WITH {USERS} SELECT user_id, CAST(gender = 'M' AS INT) AS gender_enc FROM people",
    "label_threshold": """SELECT l_orderkey, l_linenumber, l_partkey, CAST(ceil(l_quantity / 10) AS INT) AS rating,
      CAST(ceil(l_quantity / 10) >= 4 AS INT) AS liked FROM lineitem""",
    "map_labels": f"""WITH {USERS} SELECT user_id, age, CASE age WHEN 1 THEN '<18' WHEN 18 THEN '18-24' WHEN 25 THEN '25-34'
      WHEN 45 THEN '45-49' WHEN 50 THEN '50-55' ELSE CAST(age AS VARCHAR) END AS age_label FROM people""",
    "profile_defaults": f"""WITH {INTER}, {USER_STATS}
      SELECT c_custkey AS user_id, round(coalesce(nullif(user_avg_rating, 0), 3.5), 6) AS user_avg_rating,
             CAST(coalesce(nullif(user_n_ratings, 0), 20) AS DOUBLE) AS user_n_ratings, round(coalesce(nullif(user_std_rating, 0), 1.0), 6) AS user_std_rating
      FROM customer LEFT JOIN ustats ON user_id * 2 = c_custkey""",
    "minmax_scale": """SELECT p_partkey, round((p_size - min(p_size) OVER ()) / CAST(max(p_size) OVER () - min(p_size) OVER () AS DOUBLE), 6) AS p_size,
      round((p_retailprice - min(p_retailprice) OVER ()) / (max(p_retailprice) OVER () - min(p_retailprice) OVER ()), 6) AS p_retailprice FROM part""",
    "align_columns": f"""WITH {ITEMS} SELECT item_id, year, CAST(red AS DOUBLE) AS red, CAST(0 AS DOUBLE) AS no_such_column, CAST(blue AS DOUBLE) AS blue FROM things""",
    "fill_missing": f"""WITH {ITEMS}, {ITEM_STATS} SELECT item_id, title, round(coalesce(item_avg_rating, 0), 6) AS item_avg_rating,
      coalesce(item_n_ratings, 0) AS item_n_ratings FROM things LEFT JOIN (SELECT * REPLACE (item_id * 2 AS item_id) FROM istats) USING (item_id)""",
    "normalise_names": "SELECT c_custkey AS user_id, c_nationkey AS film_noir, c_mktsegment AS childrens FROM customer",
    "epoch_to_ts": f"SELECT o_orderkey, {stamp('o_orderdate')} AS at FROM orders",
    "validate_items": f"WITH {ITEMS} SELECT item_id, {errors(ERRORS_ITEMS)} FROM things",
    "validate_users": f"WITH {USERS} SELECT user_id, {errors(ERRORS_USERS)} FROM people",
    "validate_interactions": f"""WITH {INTER}, checked AS (SELECT CASE WHEN user_id <= 0 THEN 'user' WHEN item_id <= 0 THEN 'item'
      WHEN rating NOT IN (1, 2, 3, 4) THEN 'rating' WHEN epoch(ts) <= 0 THEN 'timestamp' END AS error FROM inter)
      SELECT error, count(*) AS n FROM checked GROUP BY error""",
    "quality_checks": """WITH t AS (SELECT l_partkey, l_quantity, CASE WHEN l_discount > 0.01 THEN l_discount END AS discount, CAST(l_quantity > 30 AS INT) AS liked FROM lineitem),
      a AS (SELECT count(*) AS n, avg(liked) AS rate, avg(CAST(discount IS NULL AS DOUBLE)) AS nd,
                   count(*) - count(DISTINCT (l_partkey, l_quantity, coalesce(discount, -1))) AS dup FROM t),
      c AS (SELECT 'min_rows' AS "check", n >= 1000 AS passed, 'error' AS severity, CAST(n AS DOUBLE) AS value, '' AS detail FROM a
       UNION ALL SELECT 'no_nulls', false, 'error', CASE WHEN nd > 0.05 THEN 2.0 ELSE 1.0 END, CASE WHEN nd > 0.05 THEN 'discount,nothing' ELSE 'nothing' END FROM a
       UNION ALL SELECT 'no_null_columns', false, 'error', 1.0, 'nothing' FROM a
       UNION ALL SELECT 'class_balance', rate BETWEEN 0.1 AND 0.9, 'error', round(rate, 6), '' FROM a
       UNION ALL SELECT 'no_duplicates', dup < n * 0.01, 'warn', CAST(dup AS DOUBLE), '' FROM a)
      SELECT *, (SELECT bool_and(passed) FROM c WHERE severity = 'error') AS all_passed FROM c""",
    "null_rates": """WITH r AS (SELECT avg(CAST(l_tax <= 0.02 AS DOUBLE)) AS tax, avg(CAST(l_returnflag = 'R' AS DOUBLE)) AS flag, 0.0 AS l_quantity FROM lineitem)
      SELECT "column", round(null_rate, 6) AS null_rate FROM (UNPIVOT r ON tax, flag, l_quantity INTO NAME "column" VALUE null_rate) WHERE null_rate > 0.05""",
    "duplicate_count": "SELECT count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS n_duplicates FROM lineitem",
    "min_support": "SELECT l_partkey AS item_id, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) >= 30",
    "filter_time_range": f"""SELECT 'inside' AS "case", event_id, value FROM events WHERE {RANGE_DAYS}
      UNION ALL SELECT 'fallback', event_id, value FROM events""",
    "exclude_ids": f"""WITH {INTER} SELECT user_id, item_id, order_id FROM inter i WHERE NOT EXISTS
      (SELECT 1 FROM inter x WHERE x.user_id = i.user_id AND x.item_id = i.item_id AND x.rating < 5)""",
    "file_stats": f"WITH {INTER} SELECT count(*) AS n_lines, count(*) FILTER (rating = 5) AS n_bad_fields FROM inter",
    "validate_file": f"""WITH {INTER} SELECT count(*) FILTER (ok) AS valid, count(*) FILTER (NOT ok) AS invalid
      FROM (SELECT user_id > 0 AND item_id > 0 AND rating <> 5 AND epoch(ts) > 0 AS ok FROM inter)""",
    "first_bad_lines": f"""WITH {INTER} SELECT concat_ws('::', user_id, item_id, 6, CAST(epoch(ts) AS BIGINT)) AS line
      FROM (SELECT * FROM inter WHERE rating = 5 ORDER BY order_id, line_no, item_id LIMIT 5)""",
    "read_delimited": f"""WITH {USERS} SELECT CAST(user_id AS INT) AS "UserID", gender AS "Gender", age AS "Age", CAST(occupation AS INT) AS "Occupation", '00000' AS "Zip" FROM people""",
    "rejected_lines": f"""WITH {INTER}, l AS (SELECT rating, concat_ws('::', user_id, item_id, CASE WHEN rating = 5 THEN 'five' ELSE CAST(rating AS VARCHAR) END,
        CASE WHEN rating > 1 THEN CAST(epoch(ts) AS BIGINT) END) AS line FROM inter)
      SELECT CASE WHEN rating IN (1, 5) THEN 'rejected' ELSE 'row' END AS side, line,
             CASE rating WHEN 1 THEN '3 fields instead of 4' WHEN 5 THEN 'Rating does not parse' END AS reason FROM l
      UNION ALL SELECT 'rejected', '', 'blank' FROM l WHERE rating = 2""",
    "load_items": f"""WITH {ITEMS} SELECT CAST(item_id AS INT) AS "MovieID", title AS "Title", genres AS "Genres", year AS "Year", {TAG_LIST} FROM things""",
    "load_users": f"""WITH {USERS} SELECT CAST(user_id AS INT) AS "UserID", gender AS "Gender", age AS "Age", CAST(occupation AS INT) AS "Occupation", gender_enc AS "Gender_enc" FROM people""",
    "load_interactions": f"""WITH {INTER} SELECT CAST(user_id AS INT) AS "UserID", CAST(item_id AS INT) AS "MovieID", rating AS "Rating",
      CAST(epoch(ts) AS BIGINT) AS "Timestamp", CAST(rating >= 4 AS INT) AS "Liked" FROM inter""",
    "prepared_files": f"""WITH {INTER}, {USERS}, {ITEMS}, {USER_STATS}, {ITEM_STATS}
      SELECT CAST(i.user_id AS INT) AS "UserID", CAST(i.item_id AS INT) AS "MovieID", rating AS "Rating", CAST(rating >= 4 AS INT) AS "Liked",
             CAST(epoch(i.ts) AS BIGINT) AS "Timestamp", gender_enc AS "Gender_enc", age AS "Age", CAST(occupation AS INT) AS "Occupation", year AS "Year", {TAG_LIST},
             {rnd("user_avg_rating")}, user_n_ratings, {rnd("user_std_rating")}, round(item_avg_rating, 6) AS movie_avg_rating, item_n_ratings AS movie_n_ratings
      FROM inter i JOIN people USING (user_id) JOIN things USING (item_id) JOIN ustats USING (user_id) JOIN istats USING (item_id)""",
    "stored_split": f"WITH {PARTS} SELECT user_id, order_id, line_no, item_id, year, liked, split FROM parts",
    "stored_model": f"WITH {SCORED} SELECT order_id, line_no, item_id, user_id, label, round(score, 6) AS score, pred FROM scored",
    "training_set": f"""WITH {INTER}, {USERS}, {ITEMS}, {USER_STATS}
      SELECT user_id, order_id, line_no, item_id, rating, CAST(rating >= 4 AS INT) AS liked, {stamp("i.ts")} AS at, age,
             {rnd("user_avg_rating")}, year FROM inter i JOIN people USING (user_id) JOIN ustats USING (user_id) JOIN things USING (item_id)""",
    "latest_landing": f"SELECT event_id, user_id, value, '2024-01-16' AS ingest_date FROM events WHERE ts >= TIMESTAMP '{R.EVENT_CUT}'",
    "feature_view": f"""WITH {DAILY} SELECT user_id, round(mean_value, 6) AS mean_value, n_events, {stamp("known")} AS event_timestamp, {stamp("known")} AS created, 'daily' AS view FROM daily""",
    "drift_report": f"""WITH {SUMMARY} SELECT 'lines' AS dataset, '2024-02-01 00:00:00' AS timestamp, '2024-02-01' AS run_date,
      (SELECT count(*) FILTER (is_ref) FROM both_sides) AS n_reference, (SELECT count(*) FILTER (NOT is_ref) FROM both_sides) AS n_current, summary.* FROM summary""",
    "few_values": f"WITH {FEATURE_DRIFT} SELECT * FROM drift",
    "feature_matrix": f"""WITH {MATRIX} SELECT * REPLACE ({rnd("user_avg_rating", "user_std_rating", "item_avg_rating")}) FROM matrix""",
    "historical_features": f"""WITH {INTER}, {USERS}, {USER_STATS}, v AS (SELECT * FROM people JOIN ustats USING (user_id))
      SELECT o_orderkey, o_custkey * 2 AS user_id, coalesce(age, 0) AS age, round(coalesce(user_avg_rating, 0), 6) AS user_avg_rating
      FROM orders LEFT JOIN v ON v.user_id = o_custkey * 2""",
    "point_in_time": f"""WITH {DAILY}, asked AS (SELECT event_id, user_id, ts FROM events)
      SELECT event_id, a.user_id, round(CASE WHEN ts - known <= INTERVAL 2 DAY THEN mean_value ELSE 0 END, 6) AS mean_value,
             CASE WHEN ts - known <= INTERVAL 2 DAY THEN n_events ELSE 0 END AS n_events
      FROM asked a ASOF LEFT JOIN daily d ON a.user_id = d.user_id AND a.ts >= d.known""",
    "offline_views": f"""WITH {INTER}, {USERS}, {USER_STATS}
      SELECT p.user_id, gender_enc, age, occupation, {rnd("user_avg_rating")}, user_n_ratings, {rnd("user_std_rating")},
             '2024-01-01 00:00:00' AS event_timestamp, '2024-01-01 00:00:00' AS created FROM people p JOIN ustats s ON p.user_id = s.user_id * 2""",
    "top_rated": f"""WITH {ITEMS}, {ITEM_STATS} SELECT item_id, item_n_ratings AS n, round(item_avg_rating, 6) AS mean, title
      FROM istats JOIN things USING (item_id) ORDER BY n DESC, item_id LIMIT 10""",
    "mean_by_attr": f"WITH {INTER}, {USERS} SELECT age, round(avg(rating), 6) AS mean, count(*) AS n FROM inter JOIN people USING (user_id) GROUP BY age",
    "lookup_default": f"""WITH {ITEM_STATS} SELECT p_partkey AS item_id, round(coalesce(item_avg_rating, 3.5), 6) AS item_avg_rating,
      CAST(coalesce(item_n_ratings, 10) AS DOUBLE) AS item_n_ratings FROM part LEFT JOIN istats ON item_id * 2 = p_partkey""",
    "online_features": f"""WITH {INTER}, {ITEMS}, {USER_STATS}, {ITEM_STATS}
      SELECT l_orderkey, l_linenumber, l_suppkey AS user_id, l_partkey * 2 AS item_id,
             CAST(coalesce(user_n_ratings, 0) AS DOUBLE) AS user_n_ratings, coalesce(year, 0) AS year,
             round(coalesce(item_avg_rating, 0), 6) AS item_avg_rating, CAST(0 AS DOUBLE) AS nothing
      FROM lineitem LEFT JOIN (SELECT ustats.* FROM ustats JOIN customer ON user_id = c_custkey) u ON u.user_id = l_suppkey
           LEFT JOIN (SELECT item_id, year, item_avg_rating FROM things JOIN istats USING (item_id)) i ON i.item_id = l_partkey * 2""",
    "attach_labels": f"""WITH recs AS ({recommended("side_u", 10, "")}), {ITEMS}
      SELECT recs.*, title, genres FROM recs LEFT JOIN things USING (item_id)""",
    "user_stats": f"WITH {INTER}, {USER_STATS} SELECT user_id, {rnd('user_avg_rating')}, user_n_ratings, {rnd('user_std_rating')} FROM ustats",
    "item_stats": f"WITH {ITEM_STATS} SELECT item_id, {rnd('item_avg_rating')}, item_n_ratings FROM istats",
    "value_distribution": """SELECT CAST(ceil(l_quantity / 10) AS INT) AS rating, count(*) AS n,
      round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS percent FROM lineitem GROUP BY 1""",
    "describe": "SELECT round(avg(l_extendedprice), 6) AS mean, round(median(l_extendedprice), 6) AS median, round(stddev_samp(l_extendedprice), 6) AS std FROM lineitem",
    "token_counts": "SELECT token, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS token FROM part) GROUP BY token",
    "coverage": """WITH y AS (SELECT l_partkey // 2 AS item_id, count(*) AS n FROM lineitem GROUP BY 1),
      t AS (SELECT (SELECT count(*) FROM part) AS n_items, (SELECT count(*) FROM customer) AS n_users, CAST(sum(n) AS BIGINT) AS n_ratings,
                   count(*) AS rated, count(*) FILTER (n >= 10) AS n_often FROM y)
      SELECT n_items, n_users, n_ratings, round(n_ratings * 100.0 / (n_items * n_users), 6) AS density, n_items - rated AS n_never_rated, n_often FROM t""",
    "activity": f"""WITH {INTER}, c AS (SELECT user_id, count(*) AS n FROM inter GROUP BY 1)
      SELECT min(n) AS min, max(n) AS max, round(avg(n), 6) AS mean, CAST(median(n) AS DOUBLE) AS median FROM c""",
    "attr_counts": f"""WITH {USERS} SELECT age, count(*) AS n, CASE age WHEN 1 THEN '<18' WHEN 18 THEN '18-24' WHEN 25 THEN '25-34' WHEN 35 THEN '35-44'
      WHEN 45 THEN '45-49' WHEN 50 THEN '50-55' WHEN 56 THEN '56+' END AS label FROM people GROUP BY age""",
    "label_corr": f"""WITH {LONG}, c AS (
      SELECT feature, abs(corr(x, liked)) AS r FROM (SELECT feature, x, liked FROM cont UNION ALL SELECT feature, CAST(x AS DOUBLE), liked FROM bin) GROUP BY feature)
      SELECT feature, round(r, 6) AS correlation FROM c WHERE r IS NOT NULL AND NOT isnan(r) ORDER BY r DESC, feature LIMIT 10""",
    "positive_rate": "SELECT round(avg(CAST(ceil(l_quantity / 10) >= 4 AS INT)), 6) AS positive_rate FROM lineitem",
    "cold_start": f"""WITH {INTER}, {USER_STATS}
      SELECT c_custkey AS user_id, round(coalesce(user_avg_rating, (SELECT avg(user_avg_rating) FROM ustats)), 6) AS user_avg_rating,
             round(coalesce(user_n_ratings, (SELECT avg(user_n_ratings) FROM ustats)), 6) AS user_n_ratings,
             round(coalesce(user_std_rating, (SELECT avg(user_std_rating) FROM ustats)), 6) AS user_std_rating
      FROM customer LEFT JOIN ustats ON user_id * 2 = c_custkey""",
    "roc_auc": f"""WITH t AS (SELECT l_extendedprice AS score, CAST(l_quantity > 30 AS INT) AS label FROM lineitem), a AS ({auc("t")})
      SELECT round(roc_auc, 6) AS roc_auc FROM a""",
    "latest_per_key": "SELECT user_id, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
    "split": f"WITH {INTER} SELECT {SPLIT_COLS}, CAST(rating >= 4 AS INT) AS liked, CASE WHEN {SPLIT_TEST} THEN 'test' ELSE 'train' END AS split FROM inter",
    "folds": f"WITH {INTER} SELECT {SPLIT_COLS}, rating, {FOLD} AS fold FROM inter",
    "exact_split": f"WITH {RANKED_ORDERS} SELECT o_orderkey, label, CASE WHEN r < round(n * 0.2) THEN 'test' ELSE 'train' END AS split FROM rk",
    "exact_folds": f"WITH {RANKED_ORDERS} SELECT o_orderkey, label, CAST(r % 5 AS INT) AS fold FROM rk",
    "last_n": "SELECT event_id, value FROM events ORDER BY ts DESC, event_id LIMIT 10",
    "rolling_latency": """SELECT event_id, count(*) OVER w AS n_window, round(avg(value) OVER w, 6) AS mean_latency,
      CASE WHEN count(*) OVER w >= 10 THEN round(quantile_cont(value, 0.99) OVER w, 6) ELSE 0 END AS p_latency
      FROM events WINDOW w AS (ORDER BY ts, event_id ROWS BETWEEN 999 PRECEDING AND CURRENT ROW)""",
    "top_k": f"""WITH {INTER} SELECT user_id, CAST(row_number() OVER w AS INT) AS rank, item_id, rating FROM inter
      WINDOW w AS (PARTITION BY user_id ORDER BY rating DESC, item_id, order_id, line_no) QUALIFY row_number() OVER w <= 5""",
    "page": f"WITH {ITEMS} SELECT item_id, title, genres, (SELECT count(*) FROM part) AS total FROM things ORDER BY item_id LIMIT 20 OFFSET 40",
    "long_page": f"WITH {ITEMS} SELECT item_id, title, genres, (SELECT count(*) FROM part) AS total FROM things ORDER BY item_id LIMIT 300 OFFSET 40",
    "nb_params": f"""WITH {ONE_MODEL}
      SELECT 'continuous' AS role, feature, round(lo, 6) AS lo, round(hi, 6) AS hi, round(m0, 6) AS zero, round(m1, 6) AS one,
             round(v0, 6) AS zero_var, round(v1, 6) AS one_var FROM gparams
      UNION ALL SELECT 'binary', feature, NULL, NULL, round(q0, 6), round(q1, 6), NULL, NULL FROM bparams
      UNION ALL SELECT 'prior', NULL, NULL, NULL, round(p0, 6), round(p1, 6), NULL, NULL FROM prior""",
    "nb_scores": f"WITH {SCORED} SELECT {SPLIT_COLS}, label, round(score, 6) AS score, pred FROM scored",
    "confusion": f"WITH {SCORED}, {CONFUSION} SELECT * FROM cm",
    "metrics": f"""WITH {SCORED}, {CONFUSION}, a AS ({auc("scored")})
      SELECT round((tp + tn) / (tp + tn + fp + fn), 4) AS accuracy, round(tp / (tp + fp), 4) AS "precision", round(tp / (tp + fn), 4) AS recall,
             round(2 * tp / (2 * tp + fp + fn), 4) AS f1_score, round(roc_auc, 4) AS roc_auc FROM cm, a""",
    "report": f"""WITH {SCORED}, {CONFUSION}, c AS (
        SELECT '0' AS class, tn / (tn + fn) AS p, tn / (tn + fp) AS r, 2 * tn / (2 * tn + fn + fp) AS f, tn + fp AS n FROM cm
        UNION ALL SELECT '1', tp / (tp + fp), tp / (tp + fn), 2 * tp / (2 * tp + fp + fn), tp + fn FROM cm),
      l AS (SELECT * FROM c
        UNION ALL SELECT 'accuracy', (tp + tn) / (tp + tn + fp + fn), (tp + tn) / (tp + tn + fp + fn), (tp + tn) / (tp + tn + fp + fn), tp + tn + fp + fn FROM cm
        UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), CAST(sum(n) AS BIGINT) FROM c
        UNION ALL SELECT 'weighted avg', sum(p * n) / sum(n), sum(r * n) / sum(n), sum(f * n) / sum(n), CAST(sum(n) AS BIGINT) FROM c)
      SELECT class, round(p, 6) AS "precision", round(r, 6) AS recall, round(f, 6) AS f1_score, n AS support FROM l""",
    "precision_by_tag": f"""WITH {SCORED}, l AS (UNPIVOT scored ON {TAG_LIST} INTO NAME tag VALUE flag),
      t AS (SELECT tag, count(*) AS n, count(*) FILTER (pred = 1) AS p, count(*) FILTER (pred = 1 AND label = 1) AS tp FROM l WHERE flag = 1 GROUP BY tag)
      SELECT tag, CASE WHEN p = 0 THEN 0 ELSE round(tp / p, 6) END AS "precision", n FROM t WHERE n >= 30
      ORDER BY CASE WHEN p = 0 THEN 0 ELSE tp / p END DESC, tag LIMIT 12""",
    "score_by_class": f"""WITH {SCORED}, c AS (SELECT label, min(score) AS a, avg(score) AS m, max(score) AS z FROM scored GROUP BY label)
      SELECT label, round(a, 6) AS min, round(m, 6) AS mean, round(z, 6) AS max,
             (SELECT round(max(m) FILTER (label = 1) - max(m) FILTER (label = 0), 6) FROM c) AS separation FROM c""",
    "gate": GATE_SQL,
    "training_run": TRAINING_RUN,
    "cv": f"""WITH {models(RUN_ROWS.split("), ")[0] + ")", FOLDS)}, {CV_HITS} SELECT CAST(fold AS INT) AS fold, round(accuracy, 6) AS accuracy FROM hits""",
    "grid": f"WITH {GRID} SELECT * FROM grid",
    "best_run": f"WITH {GRID} SELECT run, accuracy FROM grid WHERE accuracy > 0 ORDER BY accuracy DESC, run_order LIMIT 1",
    "recommend": recommended("side_u", 10, ""),
    "recommend_unseen": recommended(
        "mean_u", 5, "WHERE NOT EXISTS (SELECT 1 FROM inter x WHERE x.user_id = up.user_id AND x.item_id = ip.item_id)"
    ),
    "predict_like": f"""WITH {SERVED},
      ask AS (SELECT o_orderkey, o_custkey AS user_id, o_custkey * 2 AS item_id FROM orders),
      up AS ({glogit("side_u", "user_id", R.USER_SIDE)}),
      known AS (SELECT ask.*, coalesce(year, 2000.0) AS year, coalesce(item_avg_rating, 3.5) AS item_avg_rating, coalesce(item_n_ratings, 10.0) AS item_n_ratings,
        {", ".join(f'coalesce("{t}", 0) AS "{t}"' for t in R.TAGS)} FROM ask LEFT JOIN side_i USING (item_id)),
      kg AS ({glogit("known", "o_orderkey", R.ITEM_SIDE[:3])}),
      kb AS ({ITEM_B.replace("side_i", "known").replace("item_id", "o_orderkey")}),
      p AS (SELECT ask.*, (0.6 / (1 + exp(-(up.g + kg.g + ln(p1 / p0)))) + 0.4 / (1 + exp(-(d + ln(p1 / p0))))) / (0.6 + 0.4) AS score
        FROM ask JOIN up USING (user_id) JOIN kg USING (o_orderkey) JOIN kb USING (o_orderkey), prior)
      SELECT o_orderkey, user_id, item_id, score >= 0.5 AS will_like, round(score, 6) AS score FROM p""",
    "materialize": f"""WITH {DAILY}, {latest_daily("2024-01-13", "2024-01-20", "s")}
      SELECT user_id, {rnd("mean_value")}, n_events, {stamp("known")} AS at FROM s""",
    "materialize_incremental": f"""WITH {DAILY}, {latest_daily("2024-01-13", "2024-01-21", "s")}
      SELECT user_id, {rnd("mean_value")}, n_events, {stamp("known")} AS at FROM s""",
    "materialize_counts": f"""WITH {DAILY} SELECT 'one_day' AS view, count(DISTINCT user_id) AS n FROM daily WHERE known BETWEEN TIMESTAMP '2024-01-19' AND TIMESTAMP '2024-01-20'
      UNION ALL SELECT 'fallback', count(DISTINCT user_id) FROM daily""",
    "validate_online": f"""WITH {DAILY}, {latest_daily("2024-01-19", "2024-01-20", "s")},
      answer AS (SELECT event_id, user_id, coalesce(mean_value, 0.0) AS mean_value, coalesce(n_events, 0.0) AS n_events FROM events LEFT JOIN s USING (user_id)),
      absent AS (SELECT count(*) AS n FROM (VALUES ('mean_value'), ('n_events'), ('absent')) e(c) WHERE c NOT IN (SELECT unnest(json_keys(to_json(a))) FROM answer a LIMIT 4))
      SELECT 'row_count' AS "check", count(*) = (SELECT count(*) FROM events) AS passed, count(*) AS value FROM answer
      UNION ALL SELECT 'columns', n = 0, n FROM absent
      UNION ALL SELECT 'no_nulls', coalesce(sum(n), 0) = 0, CAST(coalesce(sum(n), 0) AS BIGINT) FROM (SELECT (mean_value IS NULL)::INT + (n_events IS NULL)::INT AS n FROM answer)""",
    "view_stats": f"""WITH {DAILY} SELECT 'daily' AS view, count(*) AS rows, 'user_id,event_timestamp,mean_value,n_events,created' AS columns FROM daily
      UNION ALL SELECT 'item_features', count(DISTINCT l_partkey), 'item_id,year,item_avg_rating,item_n_ratings' FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "psi": f"WITH {SIDES}, {psi_ctes('vals', 'feature')} SELECT feature, psi FROM psi",
    "ks": f"""WITH {SIDES}, {KS} SELECT feature, round(ks, 6) AS statistic, round(p_value, 6) AS p_value, p_value < 0.05 AS drifted
      FROM ks WHERE feature NOT IN ('returned', 'is_open')""",
    "wasserstein": f"WITH {SIDES}, {KS} SELECT feature, round(wasserstein, 6) AS wasserstein FROM ks WHERE feature NOT IN ('returned', 'is_open')",
    "chi2": f"""WITH t AS (SELECT ts < TIMESTAMP '{R.EVENT_CUT}' AS is_ref, event_type, CAST(length(props) AS VARCHAR) AS size FROM events),
      l AS (SELECT feature, category, count(*) FILTER (is_ref) AS r, count(*) FILTER (NOT is_ref) AS c
            FROM (SELECT 'event_type' AS feature, event_type AS category, is_ref FROM t UNION ALL SELECT 'size', size, is_ref FROM t) GROUP BY ALL),
      {chi2_ctes("l")}
      SELECT feature, round(statistic, 6) AS statistic, dof, round(p_value, 6) AS p_value, unseen_count, p_value < 0.05 AS drifted FROM chi""",
    "feature_drift": f"WITH {FEATURE_DRIFT} SELECT * FROM drift",
    "drift_summary": f"WITH {SUMMARY} SELECT * FROM summary",
    "drift_ranking": f"""WITH {SIDES}, {psi_ctes('vals', 'feature')} SELECT feature, psi,
      CASE WHEN psi < 0.1 THEN 'green' WHEN psi < 0.25 THEN 'orange' ELSE 'red' END AS severity FROM psi""",
    "retrain_decision": f"WITH {SUMMARY} SELECT global_psi AS drift_score, 'drift_report' AS reason, global_psi > 0.3 AS retrain FROM summary",
    "retrain_without_report": f"""WITH {SIDES}, {psi_ctes('vals', 'feature')}, reports AS (SELECT avg(psi) AS score, TIMESTAMP '2024-02-01' AS written FROM psi),
      r AS (SELECT max(score) AS score, count(*) AS n FROM reports WHERE written > TIMESTAMP '2024-03-01')
      SELECT CASE WHEN n = 0 THEN -1.0::DOUBLE ELSE round(score, 6) END AS drift_score, CASE WHEN n = 0 THEN 'no_report' ELSE 'drift_report' END AS reason, n = 0 OR score > 0.3 AS retrain FROM r""",
    "score_stats": f"WITH {SCORES} SELECT {SCORE_STATS} FROM score_log",
    "latency_stats": f"""WITH {LOG} SELECT endpoint, round(quantile_cont(latency_ms, 0.5), 6) AS lat_p50, round(quantile_cont(latency_ms, 0.95), 6) AS lat_p95,
      round(quantile_cont(latency_ms, 0.99), 6) AS lat_p99, round(avg(latency_ms), 6) AS lat_mean FROM log GROUP BY endpoint""",
    "score_batches": f"WITH {BATCHES} SELECT * REPLACE ({rnd('lat_p50', 'lat_p95', 'lat_p99', 'lat_mean')}) FROM batches",
    "prediction_report": f"""WITH {BATCHES} SELECT n_batches, total_predictions, round(psi, 6) AS mean_psi, round(worst, 6) AS max_psi, round(rate, 4) AS mean_pos_rate,
      round(weighted, 4) AS weighted_pos_rate, round(shift, 4) AS pos_rate_drift, {rnd("lat_p50", "lat_p95", "lat_p99", "lat_max_p99")},
      psi > 0.25 OR shift >= 0.25 AS retrain_needed FROM pred""",
    "alerts": f"""WITH {BATCHES}
      SELECT 'score_distribution_drift' AS type, CASE WHEN psi > 0.25 THEN 'red' ELSE 'orange' END AS severity, round(psi, 6) AS value FROM pred WHERE psi > 0.1
      UNION ALL SELECT 'positive_rate_shift', CASE WHEN shift < 0.25 THEN 'orange' ELSE 'red' END, round(shift, 6) FROM pred WHERE shift > 0.15
      UNION ALL SELECT 'high_latency', 'warning', round(lat_p99, 6) FROM pred WHERE lat_p99 > 500""",
    "request_metrics": f"""WITH {LOG}, m AS (SELECT (epoch_us(max(ts)) - epoch_us(min(ts))) / 60000000.0 AS minutes FROM log)
      SELECT endpoint, count(*) AS requests, round(count(*) / any_value(minutes), 6) AS per_minute, round(avg(latency_ms), 6) AS mean_latency,
             CASE WHEN count(*) >= 10 THEN round(quantile_cont(latency_ms, 0.99), 6) ELSE 0 END AS p99_latency
      FROM log, m GROUP BY GROUPING SETS ((endpoint), ())""",
    "reference_scores": f"WITH {SCORED} SELECT {SCORE_STATS} FROM scored_all WHERE split = 'train'",
    "latency_breach": latency_breach("latency_ms"),
    "error_rate": ERROR_RATE,
    "silence": SILENCE,
    "stream_windows": f"""WITH {SCORES}, w AS (SELECT date_trunc('hour', ts) AS a, count(*) AS n, avg(score) AS mean, avg(CAST(score >= 0.5 AS DOUBLE)) AS positive_rate,
        {", ".join(f"quantile_disc({middle('score')}, {q / 100}) AS p{q}" for q in (25, 50, 75))}, a + INTERVAL 1 HOUR AS window_end FROM score_log GROUP BY 1)
      SELECT {stamp("a")} AS window_start, {stamp("window_end")} AS window_end, n, {rnd("mean", "positive_rate", "p25", "p50", "p75")}, {FINAL} FROM w""",
    "stream_psi": f"""WITH {SCORES}, r AS (SELECT min(score) AS lo, max(score) AS hi, count(*) AS rn FROM score_log WHERE is_ref),
      s AS (SELECT date_trunc('day', ts) + CASE WHEN hour(ts) >= 12 THEN INTERVAL 12 HOUR ELSE INTERVAL 0 HOUR END AS a, is_ref,
              len(list_filter(range(1, 10), lambda i: score >= i * ((hi - lo) / 10.0) + lo)) AS b FROM score_log, r),
      rb AS (SELECT b, count(*) FILTER (is_ref) AS n FROM s GROUP BY b),
      wins AS (SELECT a, count(*) AS n FROM s GROUP BY a), cb AS (SELECT a, b, count(*) AS c FROM s GROUP BY ALL),
      j AS (SELECT w.a, w.n, CASE WHEN coalesce(rb.n, 0) = 0 THEN 0.001 ELSE rb.n / rn END AS rs, CASE WHEN coalesce(c, 0) = 0 THEN 0.001 ELSE c / w.n END AS cs
            FROM wins w CROSS JOIN range(10) t(k) CROSS JOIN r LEFT JOIN rb ON rb.b = k LEFT JOIN cb ON cb.a = w.a AND cb.b = k)
      SELECT {stamp("a")} AS window_start, {stamp("a + INTERVAL 12 HOUR")} AS window_end, any_value(n) AS n, round(abs(sum((cs - rs) * ln(cs / rs))), 6) AS psi,
        {FINAL.replace("window_end", "a + INTERVAL 12 HOUR")} FROM j GROUP BY a""",
    "stream_requests": f"""WITH {LOG}, w AS (SELECT date_trunc('hour', ts) AS a, endpoint, count(*) AS n, avg(latency_ms) AS mean, quantile_disc({middle("latency_ms")}, 0.99) AS p99 FROM log GROUP BY 1, 2)
      SELECT {stamp("a")} AS window_start, {stamp("a + INTERVAL 1 HOUR")} AS window_end, endpoint, n, {rnd("mean", "p99")}, {FINAL.replace("window_end", "a + INTERVAL 1 HOUR")} FROM w""",
    "stream_latency_breach": latency_breach(middle("latency_ms")),
    "stream_error_rate": ERROR_RATE,
    "stream_silence": SILENCE,
    "stream_materialize": f"""SELECT user_id, value, CAST(event_id AS DOUBLE) AS event_id, {stamp("ts")} AS at FROM events
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "stream_corrections": f"""WITH r AS (SELECT user_id, ts, ts AS created, value, event_id FROM events
        UNION ALL SELECT user_id, ts, ts + INTERVAL 1 DAY, -value, event_id FROM events WHERE event_type = 'click')
      SELECT user_id, value, CAST(event_id AS DOUBLE) AS event_id, {stamp("ts")} AS at, {stamp("created")} AS created FROM r
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, created DESC, value DESC, event_id DESC) = 1""",
}
