"""SQL for the queries on time, over the whole tables at once."""

from __future__ import annotations

from barwatch.catalog.oracle import FEATURE_COLUMNS, NARROW_BARS, ORACLE, RULES, WIDE, WIDE_BARS, r6, sql

_COUNTED = f"count(*) AS events, {r6('sum(value)', 'total')}, {r6('max(value)', 'most')}"


def _spells(name: str, source: str, gap: int) -> str:
    return f"""
{name}_rows AS (
  SELECT ticker, date, CASE WHEN date - lag(date) OVER w <= {gap} THEN 0 ELSE 1 END AS opens
  FROM {source} WINDOW w AS (PARTITION BY ticker ORDER BY date)
),
{name} AS (
  SELECT ticker, min(date) AS first_date, max(date) AS last_date, count(*) AS n
  FROM (SELECT *, sum(opens) OVER (PARTITION BY ticker ORDER BY date ROWS UNBOUNDED PRECEDING) AS run FROM {name}_rows)
  GROUP BY ticker, run
)"""


def _item_bars(bars: str, ticker: str) -> str:
    return sql(
        bars,
        f"items AS (SELECT l_orderkey, l_linenumber, l_quantity, {ticker} AS ticker, CAST(l_shipdate AS DATE) AS date FROM lineitem)",
        final=f"""
SELECT l_orderkey, l_linenumber, {r6('l_quantity', 'l_quantity')}, i.ticker, i.date, CAST(b.date AS VARCHAR) AS bar_date, {r6('b.close', 'bar_close')}
FROM items i ASOF LEFT JOIN bars b ON i.ticker = b.ticker AND i.date > b.date""",
    )


ORACLE |= {
    "stream_tumbling": f"""
SELECT CAST(floor(epoch(ts) / 21600) AS BIGINT) * 21600 AS window_start,
       CAST(floor(epoch(ts) / 21600) AS BIGINT) * 21600 + 21600 AS window_end, event_type, {_COUNTED}
FROM events GROUP BY ALL""",
    "stream_sliding": f"""
SELECT (CAST(floor(epoch(ts) / 21600) AS BIGINT) - back) * 21600 AS window_start,
       (CAST(floor(epoch(ts) / 21600) AS BIGINT) - back) * 21600 + 86400 AS window_end, event_type, {_COUNTED}
FROM events, (SELECT unnest([0, 1, 2, 3]) AS back) GROUP BY ALL""",
    "stream_sessions": f"""
SELECT CAST(floor(epoch(min(ts))) AS BIGINT) AS window_start, CAST(floor(epoch(max(ts))) AS BIGINT) + 28800 AS window_end, user_id, {_COUNTED}
FROM (
  SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run
  FROM (
    SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 8 HOURS THEN 0 ELSE 1 END AS opens
    FROM events
  )
)
GROUP BY user_id, run""",
    "stream_feature_rows": ORACLE["features"],
    "stream_rule_flags": ORACLE["rule_flags"],
    "asof_event_view": f"""
SELECT b.event_id, b.user_id, epoch_us(b.ts) AS ts, {r6('b.value', 'value')}, v.event_id AS view_id, epoch_us(v.ts) AS view_us
FROM (FROM events WHERE event_type = 'purchase') b
ASOF LEFT JOIN (FROM events WHERE event_type = 'view') v ON b.user_id = v.user_id AND b.ts >= v.ts""",
    "asof_event_view_recent": """
SELECT b.event_id, b.user_id, CASE WHEN v.ts >= b.ts - INTERVAL 6 HOURS THEN v.event_id END AS view_id
FROM (FROM events WHERE event_type = 'purchase') b
ASOF LEFT JOIN (FROM events WHERE event_type = 'view') v ON b.user_id = v.user_id AND b.ts >= v.ts""",
    "asof_item_bar": _item_bars(WIDE_BARS, "'S' || l_suppkey"),
    "asof_item_bar_sliced": _item_bars(NARROW_BARS, "l_returnflag || l_linestatus"),
    "spell_overlaps": sql(
        *WIDE,
        RULES,
        "heavy_days AS (SELECT * FROM features WHERE vol_z > 0.5)",
        _spells("odd", "rules", 10),
        _spells("heavy", "heavy_days", 30),
        final="""
SELECT o.ticker, o.first_date, o.last_date, o.n AS flags, h.first_date AS heavy_first_date, h.last_date AS heavy_last_date, h.n AS heavy_rows
FROM odd o JOIN heavy h ON o.ticker = h.ticker AND o.first_date <= h.last_date AND h.first_date <= o.last_date""",
    ),
    "spell_open_orders": sql(
        *WIDE,
        RULES,
        _spells("odd", "rules", 10),
        """
spans AS (
  SELECT 'S' || l_suppkey AS ticker, l_quantity,
         least(CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS begin, greatest(CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS until
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey
)""",
        final=f"""
SELECT o.ticker, o.first_date, o.last_date, o.n AS rows, count(*) AS items, {r6('sum(l_quantity)', 'quantity')}
FROM odd o JOIN spans s ON o.ticker = s.ticker AND o.first_date <= s.until AND s.begin <= o.last_date
GROUP BY ALL""",
    ),
}
