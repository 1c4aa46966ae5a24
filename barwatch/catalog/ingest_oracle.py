"""SQL for the queries on files, corrections, long ranks and findings."""

from __future__ import annotations

from barwatch.catalog.oracle import (
    BAR_COLUMNS,
    DIRTY,
    FEATURE_COLUMNS,
    NARROW_BARS,
    ORACLE,
    WIDE,
    WIDE_BARS,
    r6,
    sql,
)

FORM = "CAST(substr(ticker, 2) AS INTEGER) % 5"

ORACLE |= {
    "csv_universe_bars": sql(
        WIDE_BARS,
        final=f"""
        SELECT ticker, date, CAST(volume AS DOUBLE) AS volume,
               {", ".join(r6(c, c) for c in ("open", "high", "close", "adj_close"))},
               CASE WHEN day(date) <> 19 THEN (round(low, 6) + 0.0::DOUBLE) END AS low
        FROM bars WHERE {FORM} <> 0 AND day(date) NOT IN (13, 17)""",
    ),
    "csv_universe_rejected": sql(
        WIDE_BARS,
        final=f"""
        SELECT ticker, reason, count(*) AS lines
        FROM (SELECT ticker, CASE day(date) WHEN 13 THEN 'bad date' ELSE 'bad number: open' END AS reason
              FROM bars WHERE {FORM} <> 0 AND day(date) IN (13, 17))
        GROUP BY ticker, reason
        UNION ALL
        SELECT DISTINCT ticker, 'missing columns: low', 0 FROM bars WHERE {FORM} = 0""",
    ),
    "column_findings": sql(
        WIDE_BARS,
        DIRTY,
        final=" UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, {'false' if c == 'adj_close' else 'true'} AS present,
                {'count(*)' if c == 'adj_close' else 'count_if(day(date) = 9)' if c == 'open' else '0'} AS missing,
                count(*) AS rows FROM dirty"""
            for c in ("date", "ticker", "open", "high", "low", "close", "adj_close", "volume")
        ),
    ),
    "strict_findings": sql(
        WIDE_BARS,
        DIRTY,
        final="""
        SELECT CASE reason WHEN 'Negative Volume' THEN 1 WHEN 'High < max(open, close, low)' THEN 2 ELSE 3 END AS position,
               reason, count(*) AS rows, count(DISTINCT ticker) AS tickers, min(date) AS first_date
        FROM issues GROUP BY reason""",
    ),
    "long_range_rank": sql(
        NARROW_BARS,
        """
spans AS (SELECT ticker, date, (high - low) / nullif(close, 0) AS span FROM bars)""",
        final=f"""
        SELECT ticker, date, {r6('span', 'span')},
               CASE WHEN row_number() OVER w > 300
                    THEN round(len(list_filter(list(span) OVER p, lambda x: x <= span)) / 300::DOUBLE, 6) END AS span_rank
        FROM spans
        WINDOW w AS (PARTITION BY ticker ORDER BY date),
               p AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 300 PRECEDING AND 1 PRECEDING)""",
    ),
    "corrected_bars": sql(WIDE_BARS, final=f"SELECT {BAR_COLUMNS} FROM bars"),
    "corrected_features": sql(*WIDE, final=f"SELECT {FEATURE_COLUMNS} FROM features"),
}
