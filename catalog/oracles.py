"""The same queries in SQL for DuckDB.

Money is computed in whole cents with integer arithmetic, because DuckDB takes
the mean of decimals in floating point.  ``a6`` and ``q13`` follow the decimal
scales of the Spark expressions (6 for a mean, 13 for a quotient), each rounded
half-up before the final rounding to 2 places.
"""

from __future__ import annotations

MONTH = "1997-05"
GROUP = "nation_7"

LISTINGS_SQL = """
listings AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id,
    CASE WHEN o_orderkey % 31 = 0 THEN ''
         WHEN o_orderkey % 37 = 0 THEN '   '
         WHEN o_orderkey % 41 = 0 THEN NULL
         ELSE n_name END AS neighbourhood_cleansed,
    CASE WHEN o_orderkey % 17 = 0 THEN NULL
         WHEN o_orderkey % 19 = 0 THEN ''
         WHEN o_orderkey % 23 = 0 THEN '   '
         WHEN o_orderkey % 29 = 0 THEN '$0.00'
         WHEN o_orderkey % 43 = 0 THEN '-$5.00'
         WHEN o_orderkey % 47 = 0 THEN 'N/A'
         ELSE '$' || format('{:,.2f}', o_totalprice) END AS price,
    CASE WHEN o_orderkey % 53 = 0 THEN NULL
         WHEN o_orderkey % 59 = 0 THEN ' '
         WHEN o_orderkey % 61 = 0 THEN 'garbage'
         ELSE strftime(o_orderdate, '%Y-%m-%d') END AS last_scraped
  FROM orders
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
)"""


def parsed_sql(source: str, price: str, day: str) -> str:
    """``price_num`` and ``year_month`` next to the columns of ``source``."""
    return f"""
parsed AS (
  SELECT *, {price} AS price_num, strftime({day}, '%Y-%m') AS year_month
  FROM {source}
)"""


PARSED_SQL = parsed_sql(
    "listings",
    "TRY_CAST(NULLIF(trim(regexp_replace(price, '[$,]', '', 'g')), '') AS DECIMAL(10,2))",
    "TRY_CAST(last_scraped AS DATE)",
)

VERDICT_SQL = """
verdicts AS (
  SELECT * REPLACE (CASE WHEN trim(last_scraped) = '' THEN NULL ELSE last_scraped END
                    AS last_scraped),
    CASE WHEN price IS NULL OR trim(price) = '' THEN 'missing_price'
         WHEN price_num IS NULL THEN 'bad_price'
         WHEN price_num = 0 THEN 'zero_price'
         WHEN price_num < 0 THEN 'negative_price'
         WHEN last_scraped IS NULL OR trim(last_scraped) = '' THEN 'missing_date'
         WHEN year_month IS NULL THEN 'bad_date'
         WHEN neighbourhood_cleansed IS NULL OR trim(neighbourhood_cleansed) = ''
           THEN 'missing_group'
    END AS reject_reason
  FROM parsed
),
clean AS (SELECT * EXCLUDE (reject_reason) FROM verdicts WHERE reject_reason IS NULL)"""


def averages_sql(group: str) -> str:
    return f"""
cents AS (
  SELECT year_month, {group}, CAST(count(*) AS HUGEINT) AS n,
    sum(CAST(price_num * 100 AS HUGEINT)) AS s
  FROM clean GROUP BY year_month, {group}
),
averages AS (
  SELECT year_month, {group}, CAST(n AS BIGINT) AS listing_count,
    ((2 * s * 10000 + n) // (2 * n) + 5000) // 10000 AS avg_cents
  FROM cents
)"""


def diffs_sql(group: str) -> str:
    return f"""
joined AS (
  SELECT *, CAST(price_num * 100 AS HUGEINT) - avg_cents AS d
  FROM clean JOIN averages USING (year_month, {group})
),
quotients AS (
  SELECT *, sign(d) * ((2 * abs(d) * 10000000000000 + avg_cents) // (2 * avg_cents)) AS q13
  FROM joined
),
percents AS (
  SELECT *, CAST(sign(d) * ((abs(q13) * 100 + 50000000000) // 100000000000) AS BIGINT)
    AS pct_cents
  FROM quotients
),
diffs AS (
  SELECT * EXCLUDE (avg_cents, d, q13, pct_cents),
    {money("avg_cents")} AS avg_price, {money("d")} AS price_diff,
    {money("pct_cents")} AS pct_diff
  FROM percents
)"""


def money(cents: str) -> str:
    return f"CAST(CAST({cents} AS BIGINT) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2))"


GROUP_COLUMN = "neighbourhood_cleansed"
RAW = f"WITH {LISTINGS_SQL}"
PARSED = f"{RAW}, {PARSED_SQL}"
VERDICTS = f"{PARSED}, {VERDICT_SQL}"
AVERAGES = f"{VERDICTS}, {averages_sql(GROUP_COLUMN)}"
DIFFS = f"{AVERAGES}, {diffs_sql(GROUP_COLUMN)}"

DIFF_COLUMNS = (
    "year_month, neighbourhood_cleansed, id, price_num, avg_price, price_diff, pct_diff"
)


def ranked(
    k: int,
    direction: str,
    columns: str = DIFF_COLUMNS,
    where: str = "TRUE",
    partition: str = GROUP_COLUMN,
    ties: str = "id",
    base: str = DIFFS,
) -> str:
    """``columns`` and ``rank`` of the first ``k`` records per ``partition``."""
    return f"""{base}
SELECT * FROM (
  SELECT {columns}, CAST(row_number() OVER (
      PARTITION BY {partition} ORDER BY pct_diff {direction} NULLS LAST, {ties}
    ) AS INTEGER) AS rank
  FROM diffs WHERE {where}
) WHERE rank <= {k}"""


def unranked(sql: str, columns: str = DIFF_COLUMNS) -> str:
    return f"SELECT {columns} FROM ({sql})"


def average_report(where: str = "TRUE") -> str:
    return f"""{AVERAGES}
SELECT year_month, neighbourhood_cleansed, {money("avg_cents")} AS avg_price
FROM averages WHERE {where} ORDER BY avg_price DESC, year_month, neighbourhood_cleansed"""


ONE_GROUP = f"lower({GROUP_COLUMN}) = '{GROUP}'"

TOTALS = """
  count(*) AS rows_read,
  count(*) FILTER (WHERE reject_reason IS NULL) AS rows_accepted,
  count(*) FILTER (WHERE reject_reason IS NOT NULL) AS rows_rejected,
  count(*) FILTER (WHERE reject_reason = 'missing_price') AS missing_price,
  count(*) FILTER (WHERE reject_reason = 'bad_price') AS bad_price,
  count(*) FILTER (WHERE reject_reason = 'zero_price') AS zero_price,
  count(*) FILTER (WHERE reject_reason = 'negative_price') AS negative_price,
  count(*) FILTER (WHERE reject_reason = 'missing_date') AS missing_date,
  count(*) FILTER (WHERE reject_reason = 'bad_date') AS bad_date,
  count(*) FILTER (WHERE reject_reason = 'missing_group') AS missing_group"""


def typed_base(source: str, columns: str, group: str, price: str, date: str) -> str:
    """Clean records and averages of a table whose price and date are typed."""
    parsed = parsed_sql(
        f"(SELECT {columns} FROM {source})", f"TRY_CAST({price} AS DECIMAL(10,2))", date
    )
    clean = f"""
clean AS (
  SELECT * FROM parsed
  WHERE price_num > 0 AND year_month IS NOT NULL AND {group} IS NOT NULL
)"""
    return f"WITH {parsed}, {clean}, {averages_sql(group)}"


LINES = typed_base(
    "lineitem",
    "l_orderkey, l_linenumber, l_suppkey, l_extendedprice, l_shipdate",
    "l_suppkey",
    "l_extendedprice",
    "l_shipdate",
)
EVENTS = typed_base("events", "event_id, event_type, value, ts", "event_type", "value", "ts")


def typed_averages(base: str, group: str) -> str:
    return f"""{base}
SELECT year_month, {group}, listing_count, {money("avg_cents")} AS avg_price FROM averages"""


def oracle_sql() -> dict[str, str]:
    over_top = unranked(ranked(10, "DESC"))
    under_top = unranked(ranked(10, "ASC"))
    averages = f"""{AVERAGES}
SELECT year_month, neighbourhood_cleansed, listing_count, {money("avg_cents")} AS avg_price
FROM averages"""
    diffs = f"{DIFFS} SELECT {DIFF_COLUMNS} FROM diffs"
    csv_text = f"{VERDICTS} SELECT id, neighbourhood_cleansed, price FROM clean"
    sides = f"'over' AS side, {DIFF_COLUMNS}"
    return {
        "price_parse": f"{PARSED} SELECT id, price, price_num FROM parsed",
        "month_key": f"{VERDICTS} SELECT id, last_scraped, year_month FROM verdicts",
        "clean_accept": f"""{VERDICTS}
SELECT id, neighbourhood_cleansed, price_num, year_month FROM clean""",
        "clean_reject": f"""{VERDICTS}
SELECT id, reject_reason FROM verdicts WHERE reject_reason IS NOT NULL""",
        "clean_split": f"""{VERDICTS}
SELECT id, coalesce(reject_reason, 'accepted') AS verdict FROM verdicts""",
        "quality_summary": f"""{VERDICTS}
SELECT reject_reason, count(*) AS row_count FROM verdicts GROUP BY reject_reason""",
        "quality_by_month": f"""{VERDICTS}
SELECT year_month, {TOTALS} FROM verdicts GROUP BY year_month""",
        "avg_price": averages,
        "price_diffs": diffs,
        "price_diffs_split": diffs,
        "top_over": over_top,
        "top_under": under_top,
        "top_over_under": f"""SELECT {sides} FROM ({over_top})
UNION ALL SELECT 'under' AS side, {DIFF_COLUMNS} FROM ({under_top})""",
        "top_over_monthly": unranked(
            ranked(3, "DESC", partition=f"year_month, {GROUP_COLUMN}")
        ),
        "report_avg_all": average_report(),
        "report_avg_month": average_report(f"year_month = '{MONTH}'"),
        "report_avg_group": average_report(ONE_GROUP),
        "report_over_all": ranked(12, "DESC"),
        "report_under_all": ranked(12, "ASC"),
        "report_over_month": ranked(12, "DESC", where=f"year_month = '{MONTH}'"),
        "report_over_one": ranked(12, "DESC", where=ONE_GROUP),
        "report_under_one": ranked(12, "ASC", where=ONE_GROUP),
        "tracking": f"""{VERDICTS}
SELECT id, 'listings_1997-05.csv' AS source_file, 'adhoc' AS run_type,
  'batch_1' AS final_log_file_name FROM clean""",
        "csv_roundtrip": csv_text,
        "csv_text_roundtrip": "SELECT doc_id, nullif(text, '') AS text FROM documents",
        "csv_schema_read": csv_text,
        "csv_infer_read": """
SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_retailprice FROM part""",
        "parquet_roundtrip": f"""{VERDICTS}
SELECT id, neighbourhood_cleansed, price_num, year_month FROM clean""",
        "month_backfill": f"""{VERDICTS}
SELECT year_month, count(*) AS row_count FROM clean GROUP BY year_month""",
        "stored_avg_csv": average_report(ONE_GROUP),
        "stored_over_csv": ranked(5, "DESC"),
        "monthly_averages": f"""
SELECT *, 'adhoc' AS run_type, 'batch_1' AS final_log_file_name FROM ({averages})""",
        "monthly_rejects": f"""{VERDICTS}
SELECT id, reject_reason, 'adhoc' AS run_type FROM verdicts WHERE reject_reason IS NOT NULL""",
        "monthly_audit": f"""{VERDICTS}
SELECT '{MONTH}' AS month, 'SUCCESS' AS status,
  2 * count(*) AS rows_read,
  2 * count(*) FILTER (WHERE reject_reason IS NULL) AS rows_accepted,
  2 * count(*) FILTER (WHERE reject_reason IS NOT NULL) AS rows_rejected,
  2 * count(*) FILTER (WHERE reject_reason = 'bad_price') AS bad_price
FROM verdicts""",
        "monthly_report_avg": average_report(f"year_month = '{MONTH}'"),
        "backfill_report_avg": average_report("TRUE"),
        "backfill_report_over": ranked(5, "DESC"),
        "monthly_report_over": ranked(5, "DESC"),
        "monthly_report_over_deep": ranked(30, "DESC", where=f"year_month = '{MONTH}'"),
        "monthly_report_csv": ranked(5, "ASC", where=ONE_GROUP),
        "monthly_lineitem_averages": f"""
SELECT * REPLACE (CAST(l_suppkey AS VARCHAR) AS l_suppkey) FROM ({typed_averages(LINES, "l_suppkey")})""",
        "backfill_one_pass": f"""
SELECT *, CAST(sum(listing_count) OVER (PARTITION BY year_month) AS BIGINT) AS rows_accepted FROM ({averages})""",
        "monthly_report_under": ranked(5, "ASC", where=ONE_GROUP),
        "roles_lineitem_avg": typed_averages(LINES, "l_suppkey"),
        "roles_lineitem_top": ranked(
            3,
            "DESC",
            columns="year_month, l_orderkey, l_linenumber, l_suppkey, price_num, pct_diff",
            partition="l_suppkey",
            ties="l_orderkey, l_linenumber, year_month, price_num, l_shipdate",
            base=f"{LINES}, {diffs_sql('l_suppkey')}",
        ),
        "roles_events_avg": typed_averages(EVENTS, "event_type"),
        "roles_events_top": unranked(
            ranked(
                5,
                "DESC",
                columns="year_month, event_type, event_id, price_num, avg_price, price_diff, "
                "pct_diff",
                partition="event_type",
                ties="event_id",
                base=f"{EVENTS}, {diffs_sql('event_type')}",
            ),
            "year_month, event_type, event_id, price_num, avg_price, price_diff, pct_diff",
        ),
        "roles_events_renamed": f"""
WITH events_typed AS (
  SELECT strftime(ts, '%Y-%m') AS year_month, value, ts, event_type,
    TRY_CAST(value AS DECIMAL(10,2)) AS price_num
  FROM events
),
verdicts AS (
  SELECT year_month,
    CASE WHEN value IS NULL THEN 'missing_price'
         WHEN price_num IS NULL THEN 'bad_price'
         WHEN price_num = 0 THEN 'zero_price'
         WHEN price_num < 0 THEN 'negative_price'
         WHEN ts IS NULL THEN 'missing_date'
         WHEN event_type IS NULL OR trim(event_type) = '' THEN 'missing_group'
    END AS reject_reason
  FROM events_typed
)
SELECT year_month, {TOTALS} FROM verdicts GROUP BY year_month""",
    }
