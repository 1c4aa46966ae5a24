"""SQL for the registered queries, written for clarity: naive joins, no grids, no pieces."""

from __future__ import annotations

EPS2 = "(0.7::DOUBLE * 0.7::DOUBLE)"
MIN_SAMPLES = 7


def r6(expression: str, name: str) -> str:
    """A double rounded to 6 places; adding zero turns -0.0 into 0.0."""
    return f"(round({expression}, 6) + 0.0::DOUBLE) AS {name}"


def _bars(ticker: str) -> str:
    return f"""
bars AS (
  SELECT ticker, date,
         ((high_u + low_u) // 2) / 1000000::DOUBLE AS open,
         high_u / 1000000::DOUBLE AS high,
         low_u / 1000000::DOUBLE AS low,
         close_u / 1000000::DOUBLE AS close,
         close_u / 1000000::DOUBLE AS adj_close,
         volume
  FROM (
    SELECT {ticker} AS ticker, CAST(l_shipdate AS DATE) AS date,
           100000000 + 10 * max(cents) AS high_u,
           100000000 + 10 * min(cents) AS low_u,
           100000000 + (10 * CAST(sum(cents) AS BIGINT)) // count(*) AS close_u,
           CAST(sum(l_quantity) AS BIGINT) AS volume
    FROM (SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM lineitem)
    GROUP BY ALL
  )
)"""


WIDE_BARS = _bars("'S' || l_suppkey")
NARROW_BARS = _bars("l_returnflag || l_linestatus")

DIRTY = """
dirty AS (
  SELECT ticker, date, open,
         CASE WHEN day(date) = 17 THEN low - 1 ELSE high END AS high,
         CASE WHEN day(date) = 19 THEN high + 1 ELSE low END AS low,
         close, adj_close,
         CASE WHEN day(date) IN (13, 17) THEN -volume ELSE volume END AS volume
  FROM bars
),
issues AS (
  SELECT ticker, date, 'Negative Volume' AS reason FROM dirty WHERE volume < 0
  UNION ALL
  SELECT ticker, date, 'High < max(open, close, low)' FROM dirty
  WHERE high < greatest(open, close, low)
  UNION ALL
  SELECT ticker, date, 'Low > min(open, close)' FROM dirty WHERE low > least(open, close)
)"""

FEATURES = """
returns AS (
  SELECT date, ticker,
         adj_close / nullif(lag(adj_close) OVER w, 0) - 1 AS ret,
         CASE WHEN volume > 0 THEN ln(volume) END AS log_volume,
         (high - low) / nullif(close, 0) AS span,
         row_number() OVER w AS nth
  FROM bars
  WINDOW w AS (PARTITION BY ticker ORDER BY date)
),
features AS (
  SELECT date, ticker, ret,
         CASE WHEN count(ret) OVER p63 = 63
              THEN (ret - avg(ret) OVER p63) / nullif(stddev_samp(ret) OVER p63, 0) END AS ret_z,
         CASE WHEN count(log_volume) OVER p21 = 21
              THEN (log_volume - avg(log_volume) OVER p21)
                   / nullif(stddev_samp(log_volume) OVER p21, 0) END AS vol_z,
         CASE WHEN nth > 63
              THEN len(list_filter(list(span) OVER p63, lambda x: x <= span)) / 63::DOUBLE
         END AS range_pct
  FROM returns
  WINDOW p63 AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 63 PRECEDING AND 1 PRECEDING),
         p21 AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 21 PRECEDING AND 1 PRECEDING)
)"""

RULES = """
rules AS (
  SELECT date, ticker, 1 AS anomaly_flag,
         concat_ws('+ ',
           CASE WHEN abs(ret_z) > 2.5 THEN CASE WHEN ret < 0 THEN 'crash' ELSE 'spike' END END,
           CASE WHEN vol_z > 2.5 THEN 'volume_shock' END) AS type,
         ret, ret_z, vol_z, range_pct,
         concat_ws('; ',
           CASE WHEN abs(ret_z) > 2.5 THEN '|ret_z| > 2.5' END,
           CASE WHEN vol_z > 2.5 THEN 'vol_z > 2.5' END,
           CASE WHEN range_pct > 0.95 THEN 'range_pct > 0.95' END) AS why
  FROM features
  WHERE ret_z IS NOT NULL AND vol_z IS NOT NULL AND range_pct IS NOT NULL
    AND (abs(ret_z) > 2.5 OR vol_z > 2.5 OR range_pct > 0.95)
)"""

POINTS = """
split_points AS (
  SELECT date, ticker, ret, ret_z, vol_z, range_pct,
         CASE WHEN date BETWEEN DATE '1998-01-01' AND DATE '1998-12-31' THEN 'train'
              WHEN date BETWEEN DATE '1999-01-01' AND DATE '1999-12-31' THEN 'val'
              WHEN date BETWEEN DATE '2000-01-01' AND DATE '2000-03-31' THEN 'test' END AS split
  FROM features
  WHERE ret_z IS NOT NULL AND vol_z IS NOT NULL AND range_pct IS NOT NULL
),
fit AS (
  SELECT avg(ret_z) AS m1, avg(vol_z) AS m2, avg(range_pct) AS m3,
         CASE WHEN stddev_pop(ret_z) = 0 THEN 1 ELSE stddev_pop(ret_z) END AS s1,
         CASE WHEN stddev_pop(vol_z) = 0 THEN 1 ELSE stddev_pop(vol_z) END AS s2,
         CASE WHEN stddev_pop(range_pct) = 0 THEN 1 ELSE stddev_pop(range_pct) END AS s3
  FROM split_points WHERE split = 'train'
),
points AS (
  SELECT date, ticker, ret, split,
         (ret_z - m1) / s1 AS x, (vol_z - m2) / s2 AS y, (range_pct - m3) / s3 AS z
  FROM split_points, fit
  WHERE split IS NOT NULL
)"""

SCORES = """
to_centroids AS (
  SELECT *,
         sqrt((x - 0) * (x - 0) + (y - 0) * (y - 0) + (z + 1) * (z + 1)) AS d0,
         sqrt((x - 0) * (x - 0) + (y - 0) * (y - 0) + (z - 1) * (z - 1)) AS d1,
         sqrt((x - 2) * (x - 2) + (y - 0) * (y - 0) + (z - 1) * (z - 1)) AS d2
  FROM points
),
scores AS (
  SELECT date, ticker, ret, split, x, y, z,
         CAST(CASE WHEN d0 <= d1 AND d0 <= d2 THEN 0 WHEN d1 <= d2 THEN 1 ELSE 2 END AS INTEGER)
           AS cluster,
         least(d0, d1, d2) AS distance
  FROM to_centroids
),
thresholds AS (
  SELECT cluster, quantile_cont(distance, 0.95) AS threshold
  FROM scores WHERE split = 'train' GROUP BY cluster
),
kmeans AS (
  SELECT date, ticker, split, 1 AS anomaly_flag, cluster, distance
  FROM scores JOIN thresholds USING (cluster)
  WHERE distance > threshold
)"""


def noise(name: str, target: str, known: list[str]) -> str:
    """CTEs: noise points of split ``target`` among the points of the splits ``known``."""
    splits = ", ".join(f"'{s}'" for s in known)
    return f"""
{name}_known AS (
  SELECT row_number() OVER (ORDER BY ticker, date) AS id, * FROM points WHERE split IN ({splits})
),
{name}_pairs AS (
  SELECT a.id AS i, b.id AS j
  FROM {name}_known a, {name}_known b
  WHERE (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z)
        <= {EPS2}
),
{name}_core AS (
  SELECT i AS id FROM {name}_pairs GROUP BY i HAVING count(*) >= {MIN_SAMPLES}
),
{name} AS (
  SELECT date, ticker, ret, 1 AS anomaly_flag, CAST(-1 AS INTEGER) AS cluster
  FROM {name}_known
  WHERE split = '{target}'
    AND id NOT IN (SELECT i FROM {name}_pairs WHERE j IN (SELECT id FROM {name}_core))
)"""


NOISE_TRAIN = noise("noise", "train", ["train"])
NOISE_VAL = noise("noise", "val", ["train", "val"])
NOISE_TEST = noise("noise", "test", ["train", "val", "test"])

IN_VAL = "date BETWEEN DATE '1999-01-01' AND DATE '1999-12-31'"
IN_TEST = "date BETWEEN DATE '2000-01-01' AND DATE '2000-03-31'"

CARD = f"""
card AS (
  SELECT r.date, r.ticker, r.anomaly_flag, r.type, r.why,
         f.ret, f.ret_z, f.vol_z, f.range_pct, k.distance,
         CASE WHEN n.date IS NULL THEN 0 ELSE 1 END AS dbscan_flag
  FROM (SELECT * FROM rules WHERE {IN_TEST}) r
  LEFT JOIN features f ON r.date = f.date AND r.ticker = f.ticker
  LEFT JOIN (SELECT * FROM kmeans WHERE split = 'test') k
         ON r.date = k.date AND r.ticker = k.ticker
  LEFT JOIN noise n ON r.date = n.date AND r.ticker = n.ticker
)"""


def market(anomalies: str) -> str:
    return f"""
market AS (
  SELECT date, coalesce(market_ret, 0) AS market_ret, breadth,
         coalesce(flag_rate, 0) AS flag_rate,
         CASE WHEN coalesce(flag_rate, 0) > 0.05 THEN 1 ELSE 0 END AS market_anomaly_flag
  FROM (
    SELECT date, avg(ret) AS market_ret, avg(CASE WHEN ret > 0 THEN 1.0::DOUBLE ELSE 0 END) AS breadth
    FROM features GROUP BY date
  )
  LEFT JOIN (
    SELECT date, count(DISTINCT ticker) / (SELECT count(DISTINCT ticker) FROM features)::DOUBLE
             AS flag_rate
    FROM {anomalies} GROUP BY date
  ) USING (date)
)"""


def sql(*ctes: str, final: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + final


WIDE = [WIDE_BARS, FEATURES]
NARROW = [NARROW_BARS, FEATURES]

BAR_COLUMNS = ", ".join(
    ["ticker", "date", "volume"]
    + [r6(c, c) for c in ("open", "high", "low", "close", "adj_close")]
)
FEATURE_COLUMNS = ", ".join(
    ["date", "ticker"] + [r6(c, c) for c in ("ret", "ret_z", "vol_z", "range_pct")]
)
RULE_COLUMNS = f"anomaly_flag, type, why, {FEATURE_COLUMNS}"
NOISE_COLUMNS = f"date, ticker, {r6('ret', 'ret')}, anomaly_flag, cluster"
CARD_COLUMNS = f"{RULE_COLUMNS}, {r6('distance', 'distance')}, dbscan_flag"
MARKET_COLUMNS = ", ".join(
    ["date", "market_anomaly_flag"]
    + [r6(c, c) for c in ("market_ret", "breadth", "flag_rate")]
)

LABELS = f"""
known AS (
  SELECT row_number() OVER (ORDER BY ticker, date) AS id, * FROM points WHERE split = 'train'
),
pairs AS (
  SELECT a.id AS i, b.id AS j
  FROM known a, known b
  WHERE (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z)
        <= {EPS2}
),
core AS (SELECT i AS id FROM pairs GROUP BY i HAVING count(*) >= {MIN_SAMPLES}),
edges AS (
  SELECT i, j FROM pairs WHERE i IN (SELECT id FROM core) AND j IN (SELECT id FROM core)
),
roots(id, root) USING KEY (id) AS (
  SELECT id, id FROM core
  UNION
  SELECT e.j, min(r.root)
  FROM roots r JOIN edges e ON e.i = r.id JOIN recurring.roots mine ON mine.id = e.j
  WHERE r.root < mine.root
  GROUP BY e.j
),
clusters AS (
  SELECT id, CAST(dense_rank() OVER (ORDER BY root) - 1 AS INTEGER) AS cluster FROM roots
),
reached AS (
  SELECT i AS id, min(cluster) AS cluster FROM pairs JOIN clusters ON clusters.id = pairs.j
  WHERE i NOT IN (SELECT id FROM core)
  GROUP BY i
),
labels AS (
  SELECT date, ticker, CAST(coalesce(c.cluster, r.cluster, -1) AS INTEGER) AS cluster
  FROM known k LEFT JOIN clusters c ON c.id = k.id LEFT JOIN reached r ON r.id = k.id
)"""

TRAIN_PAIR_MEANS = """
train AS (
  SELECT row_number() OVER () AS id, * FROM scores WHERE split = 'train'
),
sums AS (
  SELECT a.id, a.cluster AS own, b.cluster, count(*) AS n,
         sum(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z)))
           AS linear,
         sum((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z))
           AS squared
  FROM train a, train b
  GROUP BY a.id, a.cluster, b.cluster
)"""


def silhouette(total: str) -> str:
    return f"""
SELECT {r6('avg(CASE WHEN own_n = 1 THEN 0 ELSE coalesce((b - a) / nullif(greatest(a, b), 0), 0) END)', 'silhouette')}
FROM (
  SELECT id, max(CASE WHEN own = cluster THEN n END) AS own_n,
         max(CASE WHEN own = cluster THEN {total} / nullif(n - 1, 0) END) AS a,
         min(CASE WHEN own <> cluster THEN {total} / n END) AS b
  FROM sums GROUP BY id
)"""


def histogram_rows(table: str, columns: list[str], group: str | None = None) -> str:
    tag = f"{group}, " if group else ""
    parts = " UNION ALL ".join(
        f"SELECT {tag}'{c}' AS feature, {c} AS value FROM {table} WHERE {c} IS NOT NULL"
        for c in columns
    )
    return f"""
long AS ({parts}),
limits AS (
  SELECT {tag}feature, count(*) AS total, min(value) AS low, max(value) - min(value) AS span
  FROM long GROUP BY {tag}feature
),
counted AS (
  SELECT {tag}feature, CAST(least(floor((value - low) / span * 50), 49) AS INTEGER) AS bin,
         count(*) AS found
  FROM long JOIN limits USING ({tag}feature)
  GROUP BY ALL
),
binned AS (
  SELECT {tag}feature, bin, coalesce(found, 0) AS points, low, span, total
  FROM limits CROSS JOIN (SELECT CAST(n AS INTEGER) AS bin FROM generate_series(0, 49) series(n))
  LEFT JOIN counted USING ({tag}feature, bin)
)"""


DETECTED_TEST = f"""
tagged AS (
  SELECT 'rule' AS detector, date, ticker FROM rules WHERE {IN_TEST}
  UNION ALL SELECT 'kmeans', date, ticker FROM kmeans WHERE split = 'test'
  UNION ALL SELECT 'dbscan', date, ticker FROM noise
)"""

ORACLE = {
    "bars": sql(WIDE_BARS, final=f"SELECT {BAR_COLUMNS} FROM bars"),
    "bars_narrow": sql(NARROW_BARS, final=f"SELECT {BAR_COLUMNS} FROM bars"),
    "csv_bars": sql(
        NARROW_BARS,
        final="SELECT * REPLACE (CAST(volume AS DOUBLE) AS volume) FROM "
        f"(SELECT {BAR_COLUMNS} FROM bars)",
    ),
    "stored_month": sql(
        *WIDE,
        final=f"SELECT {FEATURE_COLUMNS}, strftime(date, '%Y-%m') AS month FROM features "
        "WHERE strftime(date, '%Y-%m') = '2000-02'",
    ),
    "quality_issues": sql(WIDE_BARS, DIRTY, final="SELECT ticker, date, reason FROM issues"),
    "quality_clean": sql(
        WIDE_BARS,
        DIRTY,
        final=f"SELECT {BAR_COLUMNS} FROM dirty "
        "WHERE (ticker, date) NOT IN (SELECT (ticker, date) FROM issues)",
    ),
    "quality_report": sql(
        WIDE_BARS,
        DIRTY,
        final="""
SELECT ticker, rows_before, rows_after,
       coalesce(negative_volume, 0) AS negative_volume, coalesce(high_too_low, 0) AS high_too_low,
       coalesce(low_too_high, 0) AS low_too_high, coalesce(reasons, '') AS reasons
FROM (
  SELECT ticker, count(*) AS rows_before,
         CAST(sum(CASE WHEN (ticker, date) IN (SELECT (ticker, date) FROM issues) THEN 0 ELSE 1 END)
              AS BIGINT) AS rows_after
  FROM dirty GROUP BY ticker
)
LEFT JOIN (
  SELECT ticker,
         CAST(sum(CASE WHEN reason = 'Negative Volume' THEN 1 ELSE 0 END) AS BIGINT)
           AS negative_volume,
         CAST(sum(CASE WHEN reason = 'High < max(open, close, low)' THEN 1 ELSE 0 END) AS BIGINT)
           AS high_too_low,
         CAST(sum(CASE WHEN reason = 'Low > min(open, close)' THEN 1 ELSE 0 END) AS BIGINT)
           AS low_too_high,
         string_agg(DISTINCT reason, '; ' ORDER BY reason) AS reasons
  FROM issues GROUP BY ticker
) USING (ticker)""",
    ),
    "reason_counts": sql(
        WIDE_BARS,
        DIRTY,
        final="SELECT ticker, reason, count(*) AS count FROM issues GROUP BY ticker, reason",
    ),
    "duplicate_bars": sql(
        WIDE_BARS,
        DIRTY,
        final=f"""
SELECT {BAR_COLUMNS} FROM dirty WHERE day(date) = 23
UNION ALL SELECT {BAR_COLUMNS} FROM dirty WHERE day(date) = 23""",
    ),
    "out_of_order_bars": sql(
        WIDE_BARS,
        """
placed AS (
  SELECT ticker, date, lag(date) OVER (PARTITION BY ticker ORDER BY place) AS previous_date
  FROM (
    SELECT ticker, date,
           datediff('day', DATE '1970-01-01', date) * 2 + CASE WHEN day(date) = 11 THEN 5 ELSE 0 END
             AS place
    FROM bars
  )
)""",
        final="SELECT ticker, date, previous_date FROM placed WHERE date < previous_date",
    ),
    "missing_tickers": sql(
        WIDE_BARS,
        final="""
SELECT DISTINCT 'S' || key AS ticker
FROM (SELECT s_suppkey AS key FROM supplier UNION ALL SELECT s_suppkey * 2 + 1 FROM supplier)
WHERE 'S' || key NOT IN (SELECT ticker FROM bars)""",
    ),
    "features": sql(*WIDE, final=f"SELECT {FEATURE_COLUMNS} FROM features"),
    "features_narrow": sql(*NARROW, final=f"SELECT {FEATURE_COLUMNS} FROM features"),
    "eda": sql(
        WIDE_BARS,
        final=f"""
SELECT date, ticker, {r6('adj_close', 'adj_close')},
       {r6('adj_close / nullif(lag(adj_close) OVER (PARTITION BY ticker ORDER BY date), 0) - 1', 'daily_return')},
       {r6('CASE WHEN volume > 0 THEN ln(volume) END', 'log_volume')}
FROM bars""",
    ),
    "rule_flags": sql(*WIDE, RULES, final=f"SELECT {RULE_COLUMNS} FROM rules"),
    "rule_flags_narrow": sql(*NARROW, RULES, final=f"SELECT {RULE_COLUMNS} FROM rules"),
    "type_counts": sql(
        *NARROW, RULES, final="SELECT type, count(*) AS anomalies FROM rules GROUP BY type"
    ),
    "scaled_features": sql(
        *WIDE,
        POINTS,
        final="SELECT date, ticker, split, "
        + ", ".join(
            [r6("ret", "ret"), r6("x", "ret_z"), r6("y", "vol_z"), r6("z", "range_pct")]
        )
        + " FROM points",
    ),
    "kmeans_scores": sql(
        *WIDE,
        POINTS,
        SCORES,
        final=f"SELECT date, ticker, split, cluster, {r6('distance', 'distance')} FROM scores",
    ),
    "kmeans_thresholds": sql(
        *WIDE,
        POINTS,
        SCORES,
        final=f"""
SELECT cluster, {r6('quantile_cont(distance, 0.975)', 'threshold')}
FROM scores WHERE split = 'train' GROUP BY cluster""",
    ),
    "kmeans_fixed": sql(
        *WIDE,
        POINTS,
        SCORES,
        final=f"""
SELECT date, ticker, anomaly_flag, cluster, {r6('distance', 'distance')}
FROM kmeans WHERE split = 'val'""",
    ),
    "kmeans_fit_check": sql(
        *WIDE,
        POINTS,
        final="""
SELECT CAST(k AS INTEGER) AS k, k AS clusters, points,
       round(squares / points, 2) AS spread, round(squares / points, 2) AS spread_fit
FROM (SELECT count(*) AS points, sum(x * x + y * y + z * z) AS squares FROM points WHERE split = 'train'),
     generate_series(2, 7) candidates(k)""",
    ),
    "silhouette_linear": sql(
        *WIDE, POINTS, SCORES, TRAIN_PAIR_MEANS, final=silhouette("squared")
    ),
    "silhouette_pairwise": sql(
        *NARROW, POINTS, SCORES, TRAIN_PAIR_MEANS, final=silhouette("linear")
    ),
    "dbscan_noise_train": sql(
        *WIDE, POINTS, NOISE_TRAIN, final=f"SELECT {NOISE_COLUMNS} FROM noise"
    ),
    "dbscan_noise_val": sql(*WIDE, POINTS, NOISE_VAL, final=f"SELECT {NOISE_COLUMNS} FROM noise"),
    "dbscan_noise_test": sql(*WIDE, POINTS, NOISE_TEST, final=f"SELECT {NOISE_COLUMNS} FROM noise"),
    "dbscan_noise_rate": sql(
        *WIDE,
        POINTS,
        NOISE_TRAIN,
        final=f"""
SELECT points, noise, {r6('noise / points::DOUBLE', 'noise_rate')}
FROM (
  SELECT (SELECT count(*) FROM points WHERE split = 'train') AS points,
         (SELECT count(*) FROM noise) AS noise
)""",
    ),
    "dbscan_labels_narrow": "WITH RECURSIVE "
    + ",".join([*NARROW, POINTS, LABELS])
    + "\nSELECT date, ticker, cluster FROM labels",
    "k_distances": sql(
        *WIDE,
        POINTS,
        final=f"""
SELECT a.date, a.ticker,
       {r6('sqrt(min((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z), 7)[7])', 'k_distance')}
FROM points a, points b
WHERE a.split = 'train' AND b.split = 'train'
GROUP BY a.date, a.ticker""",
    ),
    "daily_card": sql(
        *WIDE, RULES, POINTS, SCORES, NOISE_TEST, CARD, final=f"SELECT {CARD_COLUMNS} FROM card"
    ),
    "daily_card_narrow": sql(
        *NARROW, RULES, POINTS, SCORES, NOISE_TEST, CARD, final=f"SELECT {CARD_COLUMNS} FROM card"
    ),
    "market_days": sql(
        *WIDE, RULES, market("rules"), final=f"SELECT {MARKET_COLUMNS} FROM market"
    ),
    "date_query_market": sql(
        *WIDE,
        RULES,
        market(f"(SELECT * FROM rules WHERE {IN_TEST})"),
        final=f"SELECT {MARKET_COLUMNS} FROM market WHERE date = DATE '2000-02-17'",
    ),
    "date_query_card": sql(
        *WIDE,
        RULES,
        final=f"""
SELECT ticker, type, {r6('ret_z', 'ret_z')}, {r6('vol_z', 'vol_z')}, why
FROM rules WHERE date = DATE '2000-02-17'""",
    ),
    "month_query": sql(
        *WIDE,
        RULES,
        market(f"(SELECT * FROM rules WHERE {IN_TEST})"),
        final=f"""
SELECT r.date, ticker, type, {r6('ret_z', 'ret_z')}, {r6('vol_z', 'vol_z')},
       market_anomaly_flag, why
FROM rules r LEFT JOIN market m ON r.date = m.date
WHERE strftime(r.date, '%Y-%m') = '2000-02'""",
    ),
    "month_query_empty": sql(
        *WIDE,
        RULES,
        market(f"(SELECT * FROM rules WHERE {IN_TEST})"),
        final=f"""
SELECT r.date, ticker, type, {r6('ret_z', 'ret_z')}, {r6('vol_z', 'vol_z')},
       market_anomaly_flag, why
FROM rules r LEFT JOIN market m ON r.date = m.date
WHERE strftime(r.date, '%Y-%m') = '1999-11' AND r.date >= DATE '2000-01-01'""",
    ),
    "consensus_flags": sql(
        *WIDE,
        POINTS,
        SCORES,
        NOISE_VAL,
        final="""
SELECT coalesce(k.date, n.date) AS date, coalesce(k.ticker, n.ticker) AS ticker,
       CASE WHEN k.date IS NULL THEN 0 ELSE 1 END AS kmeans_flag,
       CASE WHEN n.date IS NULL THEN 0 ELSE 1 END AS dbscan_flag,
       1 AS union_flag,
       CASE WHEN k.date IS NOT NULL AND n.date IS NOT NULL THEN 1 ELSE 0 END AS intersection_flag
FROM (SELECT * FROM kmeans WHERE split = 'val') k
FULL JOIN noise n ON k.date = n.date AND k.ticker = n.ticker""",
    ),
    "consensus_market": sql(
        *WIDE,
        POINTS,
        SCORES,
        NOISE_VAL,
        final=f"""
SELECT date, {r6('flag_rate', 'flag_rate')}, {r6('r_mkt', 'r_mkt')}, {r6('breadth', 'breadth')}
FROM (
  SELECT date, count(DISTINCT ticker) / (SELECT count(DISTINCT ticker) FROM features)::DOUBLE
           AS flag_rate
  FROM kmeans WHERE split = 'val' GROUP BY date
)
FULL JOIN (SELECT date, avg(ret) AS r_mkt FROM noise GROUP BY date) USING (date)
FULL JOIN (
  SELECT date, avg(CASE WHEN ret > 0 THEN 1.0::DOUBLE ELSE 0 END) AS breadth
  FROM features WHERE {IN_VAL} GROUP BY date
) USING (date)""",
    ),
    "unique_dates": sql(
        *WIDE, RULES, final="SELECT count(DISTINCT date) AS unique_dates FROM rules"
    ),
    "anomaly_rate": sql(
        *WIDE,
        RULES,
        final=f"""
SELECT anomaly_dates, reference_dates,
       {r6('anomaly_dates / reference_dates::DOUBLE', 'anomaly_rate')}
FROM (
  SELECT (SELECT count(DISTINCT date) FROM rules) AS anomaly_dates,
         (SELECT count(DISTINCT date) FROM features) AS reference_dates
)""",
    ),
    "overlap_dates": sql(
        *WIDE,
        RULES,
        POINTS,
        SCORES,
        f"""
r AS (SELECT DISTINCT date FROM rules WHERE {IN_VAL}),
k AS (SELECT DISTINCT date FROM kmeans WHERE split = 'val')""",
        final="""
SELECT (SELECT count(*) FROM r WHERE date NOT IN (SELECT date FROM k)) AS rule_only,
       (SELECT count(*) FROM k WHERE date NOT IN (SELECT date FROM r)) AS kmeans_only,
       (SELECT count(*) FROM r WHERE date IN (SELECT date FROM k)) AS both""",
    ),
    "daily_counts": sql(
        *WIDE, RULES, final="SELECT date, count(*) AS anomalies FROM rules GROUP BY date"
    ),
    "ticker_counts": sql(
        *WIDE, RULES, final="SELECT ticker, count(*) AS anomalies FROM rules GROUP BY ticker"
    ),
    "anomaly_summary": sql(
        *WIDE,
        RULES,
        final=f"""
SELECT count(*) AS rows, count(DISTINCT date) AS unique_dates,
       count(DISTINCT ticker) AS unique_tickers,
       {r6('count(*) / count(DISTINCT date)::DOUBLE', 'avg_anomalies_per_day')}
FROM rules""",
    ),
    "split_overlap": sql(
        *WIDE,
        RULES,
        POINTS,
        SCORES,
        f"""
flagged AS (
  SELECT split, date, max(rule) AS rule, max(kmeans) AS kmeans
  FROM (
    SELECT CASE WHEN {IN_VAL} THEN 'val' ELSE 'test' END AS split, date, 1 AS rule, 0 AS kmeans
    FROM rules WHERE {IN_VAL} OR {IN_TEST}
    UNION ALL SELECT split, date, 0, 1 FROM kmeans WHERE split IN ('val', 'test')
  )
  GROUP BY split, date
)""",
        final="""
SELECT split, CAST(sum(rule) AS BIGINT) AS rule_dates, CAST(sum(kmeans) AS BIGINT) AS kmeans_dates,
       CAST(sum(rule * kmeans) AS BIGINT) AS all_dates
FROM flagged GROUP BY split""",
    ),
    "three_way_overlap": sql(
        *WIDE,
        RULES,
        POINTS,
        SCORES,
        NOISE_TEST,
        DETECTED_TEST,
        final="""
SELECT count(DISTINCT date) FILTER (detector = 'rule') AS rule_dates,
       count(DISTINCT date) FILTER (detector = 'kmeans') AS kmeans_dates,
       count(DISTINCT date) FILTER (detector = 'dbscan') AS dbscan_dates,
       (SELECT count(*) FROM (
          SELECT date FROM tagged GROUP BY date HAVING count(DISTINCT detector) = 3)) AS all_dates
FROM tagged""",
    ),
    "detector_daily_counts": sql(
        *WIDE,
        RULES,
        POINTS,
        SCORES,
        NOISE_TEST,
        DETECTED_TEST,
        final="""
SELECT date,
       count(*) FILTER (detector = 'rule') AS rule,
       count(*) FILTER (detector = 'kmeans') AS kmeans,
       count(*) FILTER (detector = 'dbscan') AS dbscan
FROM tagged GROUP BY date""",
    ),
    "flag_rates": sql(
        *WIDE,
        RULES,
        POINTS,
        SCORES,
        NOISE_TEST,
        DETECTED_TEST,
        final=f"""
SELECT detector, count(ticker) AS flagged, any_value(total) AS points,
       {r6('count(ticker) * 100.0::DOUBLE / any_value(total)', 'flag_rate_pct')}
FROM (VALUES ('rule'), ('kmeans'), ('dbscan')) names(detector)
LEFT JOIN tagged USING (detector),
     (SELECT count(*) AS total FROM points WHERE split = 'test')
GROUP BY detector""",
    ),
    "null_share": sql(
        *WIDE,
        final=" UNION ALL ".join(
            f"""
SELECT '{c}' AS "column", {r6(f'avg(CASE WHEN {c} IS NULL THEN 1.0::DOUBLE ELSE 0 END)', 'null_share')}
FROM features"""
            for c in ("date", "ticker", "ret", "ret_z", "vol_z", "range_pct")
        ),
    ),
    "feature_histogram": sql(
        *WIDE,
        histogram_rows("features", ["ret_z", "vol_z", "range_pct"]),
        final=f"""
SELECT feature, bin, {r6('low + bin * span / 50', 'bin_start')}, points FROM binned""",
    ),
    "distance_histogram": sql(
        *WIDE,
        POINTS,
        SCORES,
        histogram_rows("scores", ["distance"], "split"),
        final=f"""
SELECT split, feature, bin, {r6('low + bin * span / 50', 'bin_start')}, points,
       {r6('points * 50 / (total * span)', 'density')}
FROM binned""",
    ),
    "feature_correlation": sql(
        *WIDE,
        final=" UNION ALL ".join(
            f"SELECT '{a}' AS a, '{b}' AS b, {r6(f'corr({a}, {b})', 'corr')} FROM features"
            for a in ("ret_z", "vol_z", "range_pct")
            for b in ("ret_z", "vol_z", "range_pct")
        ),
    ),
    "slice_ticker": sql(
        *WIDE, final=f"SELECT {FEATURE_COLUMNS} FROM features WHERE ticker = 'S7'"
    ),
    "slice_period": sql(*WIDE, RULES, final=f"SELECT {RULE_COLUMNS} FROM rules WHERE {IN_VAL}"),
    "preview": sql(
        *WIDE, final=f"SELECT {FEATURE_COLUMNS} FROM features ORDER BY date, ticker LIMIT 5"
    ),
}

# Two ways of computing the same table share their SQL.
ORACLE["quality_drop_listed"] = ORACLE["quality_clean"]
ORACLE["quality_gate"] = ORACLE["quality_clean"]
ORACLE["features_pieces"] = ORACLE["features"]
ORACLE["dbscan_added_val"] = ORACLE["dbscan_noise_val"]
ORACLE["dbscan_added_test"] = ORACLE["dbscan_noise_test"]
ORACLE["kmeans_thresholds_searched"] = ORACLE["kmeans_thresholds"]
ORACLE["dbscan_labels"] = (
    "WITH RECURSIVE "
    + ",".join([*WIDE, POINTS, LABELS])
    + "\nSELECT date, ticker, cluster FROM labels"
)


KM_STARTS, KM_DRAWS, KM_DRAWN, KM_SEED = 3, 2, 100, 42


def _square(a: str, b: str) -> str:
    return " + ".join(f"({a}.{c} - {b}.{c}) * ({a}.{c} - {b}.{c})" for c in "xyz")


def _lloyd(name: str, first: str, rows: str, weight: str) -> str:
    """(round, cs, moved): centroids as a list of structs, moved to the weighted means of their rows until they settle."""
    parts = ", ".join(f"'{c}': sum({weight} * {c}) / sum({weight})" for c in "xyz")
    return f"""
{name} AS (
  SELECT 0 AS round, list({{'x': x, 'y': y, 'z': z}} ORDER BY i) AS cs, 1e300::DOUBLE AS moved FROM {first}
  UNION ALL
  SELECT round + 1, means, list_max(list_transform(list_zip(means, cs), lambda p: {_square('p[1]', 'p[2]')}))
  FROM (
    SELECT round, cs, list_transform(range(len(cs)), lambda i: coalesce(list_extract(map_extract(found, i), 1), cs[i + 1])) AS means
    FROM (
      SELECT round, cs, map_from_entries(list((c, mean))) AS found
      FROM (
        SELECT round, cs, c, {{{parts}}} AS mean
        FROM (
          SELECT *, list_position(squares, list_min(squares)) - 1 AS c
          FROM (SELECT l.round, l.cs, t.*, list_transform(l.cs, lambda q: {_square('t', 'q')}) AS squares
                FROM {name} l, {rows} t WHERE l.moved > 1e-8 AND l.round < 300)
        )
        GROUP BY round, cs, c
      ) GROUP BY round, cs
    )
  )
)"""


def fitted(k: int) -> list[str]:
    """Tables of a K-Means fit: ``fit{k}`` has its centroids (i, x, y, z, inertia), in order."""
    tables = []
    for start in range(KM_STARTS):
        tag = f"{k}_{start}"

        def u(draw: int) -> str:
            text = f"date || '|' || ticker || '|{KM_SEED}/{k}/{start}/{draw}'"
            return f"((CAST('0x' || substr(md5({text}), 1, 13) AS BIGINT) + 0.5) / 16::DOUBLE ** 13)"

        tables.append(f"""
cands{tag}_0 AS MATERIALIZED (
  SELECT CAST(0 AS BIGINT) AS i, x, y, z FROM train ORDER BY -ln({u(0)}), date, ticker LIMIT 1
)""")
        for draw in range(1, KM_DRAWS + 1):
            before = f"cands{tag}_{draw - 1}"
            tables.append(f"""
cands{tag}_{draw} AS MATERIALIZED (
  FROM {before}
  UNION ALL
  SELECT (SELECT count(*) FROM {before}) + row_number() OVER (ORDER BY race, date, ticker) - 1, x, y, z
  FROM (
    SELECT *, -ln({u(draw)}) / away AS race
    FROM (SELECT t.date, t.ticker, t.x, t.y, t.z, min({_square('t', 'c')}) AS away FROM train t, {before} c GROUP BY ALL)
    WHERE away > 0
    ORDER BY race, date, ticker LIMIT {KM_DRAWN}
  )
)""")
        tables.append(f"""
weighed{tag} AS MATERIALIZED (
  SELECT c.i, c.x, c.y, c.z, coalesce(n, 0)::DOUBLE AS w
  FROM cands{tag}_{KM_DRAWS} c LEFT JOIN (
    SELECT i, count(*) AS n
    FROM (SELECT c.i FROM train t, cands{tag}_{KM_DRAWS} c
          QUALIFY row_number() OVER (PARTITION BY t.date, t.ticker ORDER BY {_square('t', 'c')}, c.i) = 1)
    GROUP BY i
  ) USING (i)
)""")
        tables.append(f"""
taken{tag}_1 AS (SELECT CAST(0 AS BIGINT) AS i, x, y, z FROM (FROM weighed{tag} ORDER BY w DESC, i LIMIT 1))""")
        for n in range(2, k + 1):
            tables.append(f"""
taken{tag}_{n} AS MATERIALIZED (
  FROM taken{tag}_{n - 1}
  UNION ALL
  SELECT CAST({n - 1} AS BIGINT), x, y, z FROM (
    SELECT c.i, c.x, c.y, c.z, c.w * min({_square('c', 't')}) AS gain FROM weighed{tag} c, taken{tag}_{n - 1} t
    GROUP BY c.i, c.x, c.y, c.z, c.w HAVING gain > 0 ORDER BY gain DESC, c.i LIMIT 1
  )
)""")
        tables.append(_lloyd(f"rough{tag}", f"taken{tag}_{k}", f"weighed{tag}", "w"))
        tables.append(f"""
first{tag} AS MATERIALIZED (
  SELECT generate_subscripts(cs, 1) AS i, unnest(cs, recursive := true)
  FROM (SELECT cs FROM rough{tag} ORDER BY round DESC LIMIT 1)
)""")
    costs = " UNION ALL ".join(
        f"SELECT {s} AS start, sum(list_min(list_transform(cs, lambda q: {_square('t', 'q')}))) AS inertia "
        f"FROM train t, (SELECT list({{'x': x, 'y': y, 'z': z}} ORDER BY i) AS cs FROM first{k}_{s})"
        for s in range(KM_STARTS)
    )
    firsts = " UNION ALL ".join(f"SELECT {s} AS start, * FROM first{k}_{s}" for s in range(KM_STARTS))
    tables.append(f"""
best{k} AS MATERIALIZED (
  SELECT i, x, y, z FROM ({firsts}) WHERE start = (SELECT start FROM ({costs}) ORDER BY inertia, start LIMIT 1)
)""")
    tables.append(_lloyd(f"fine{k}", f"best{k}", "train", "1"))
    tables.append(f"""
fit{k} AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY x, y, z) - 1 AS i, x, y, z, inertia
  FROM (
    SELECT unnest(cs, recursive := true), (SELECT sum(list_min(list_transform(f.cs, lambda q: {_square('t', 'q')}))) FROM train t) AS inertia
    FROM (SELECT cs FROM fine{k} ORDER BY round DESC LIMIT 1) f
  )
)""")
    return tables


TRAIN = """
train AS MATERIALIZED (SELECT date, ticker, x, y, z FROM points WHERE split = 'train')"""


def with_fits(*ctes: str, final: str) -> str:
    return "WITH RECURSIVE " + ",".join(ctes) + "\n" + final


ORACLE["kmeans_fitted"] = with_fits(
    *WIDE,
    POINTS,
    TRAIN,
    *fitted(3),
    f"""
fit_scores AS MATERIALIZED (
  SELECT date, ticker, split, CAST(i AS INTEGER) AS cluster, distance
  FROM (SELECT p.date, p.ticker, p.split, f.i, sqrt({_square('p', 'f')}) AS distance FROM points p, fit3 f)
  QUALIFY row_number() OVER (PARTITION BY date, ticker ORDER BY distance, i) = 1
),
fit_thresholds AS (
  SELECT cluster, quantile_cont(distance, 0.95) AS threshold FROM fit_scores WHERE split = 'train' GROUP BY cluster
)""",
    final=f"""
SELECT date, ticker, 1 AS anomaly_flag, cluster, {r6('distance', 'distance')}
FROM fit_scores JOIN fit_thresholds USING (cluster) WHERE split = 'test' AND distance > threshold""",
)


def _silhouette_of(k: int) -> str:
    """Mean silhouette under squared distance of one fit, from sums per cluster."""
    return f"""
near{k} AS MATERIALIZED (
  SELECT t.date, t.ticker, t.x, t.y, t.z, f.i AS own FROM train t, fit{k} f
  QUALIFY row_number() OVER (PARTITION BY t.date, t.ticker ORDER BY sqrt({_square('t', 'f')}), f.i) = 1
),
sums{k} AS MATERIALIZED (
  SELECT own AS i, count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(z) AS sz, sum(x * x + y * y + z * z) AS ss FROM near{k} GROUP BY own
),
score{k} AS (
  SELECT avg(CASE WHEN own_n = 1 THEN 0 ELSE coalesce((b - a) / nullif(greatest(a, b), 0), 0) END) AS silhouette
  FROM (
    SELECT max(CASE WHEN i = own THEN n END) AS own_n, max(CASE WHEN i = own THEN far / nullif(n - 1, 0) END) AS a,
           min(CASE WHEN i <> own THEN far / n END) AS b
    FROM (SELECT t.*, s.i, s.n, greatest(0, s.n * (x * x + y * y + z * z) - 2 * (x * sx + y * sy + z * sz) + ss) AS far
          FROM near{k} t, sums{k} s)
    GROUP BY date, ticker
  )
)"""


ORACLE["kmeans_selection"] = with_fits(
    *WIDE,
    POINTS,
    TRAIN,
    *[t for k in range(2, 8) for t in [*fitted(k), _silhouette_of(k)]],
    final=" UNION ALL ".join(
        f"SELECT CAST({k} AS INTEGER) AS k, {r6(f'(SELECT max(inertia) FROM fit{k})', 'inertia')}, {r6('silhouette', 'silhouette')} FROM score{k}"
        for k in range(2, 8)
    ),
)
