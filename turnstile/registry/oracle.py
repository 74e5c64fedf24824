"""The SQL counterpart of every query, for another engine to run."""

from .. import schemas
from ..plans import quality
from .oracle_tables import PRELUDE

_SQL: dict[str, str] = {}


def _add(name: str, select: str) -> None:
    """A query over the given tables alone, or over the derived ones."""
    _SQL[name] = select.strip()


def _model(name: str, select: str) -> None:
    _SQL[name] = f"{PRELUDE}\n{select.strip()}"


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# Column lists with numbers as DOUBLE and dates as text, as the queries show them.
SALES = """sales_id, sales_source, transaction_id, ticket_id, event_id, event_name,
  organizer_id, customer_id, customer_first_name, customer_last_name, reseller_id,
  reseller_name, sales_channel, seller_id, seller_type, seller_name,
  quantity::DOUBLE AS quantity, total_amount::DOUBLE AS total_amount,
  unit_price::DOUBLE AS unit_price, sales_date::VARCHAR AS sales_date,
  office_location, source_file_name, load_ts::VARCHAR AS load_ts, source_system,
  batch_id, updated_at::VARCHAR AS updated_at"""
FACT = """sales_key, sales_id, sales_source, customer_id, reseller_id, organizer_id,
  event_id, sales_date::VARCHAR AS sales_date, sales_channel, seller_type, seller_id,
  seller_name, quantity::DOUBLE AS quantity, unit_price::DOUBLE AS unit_price,
  total_amount::DOUBLE AS total_amount, commission_rate::DOUBLE AS commission_rate,
  commission_amount::DOUBLE AS commission_amount, source_file_name, source_system,
  batch_id, load_ts::VARCHAR AS load_ts, updated_at::VARCHAR AS updated_at"""
META = """load_ts::VARCHAR AS load_ts, source_system, batch_id,
  updated_at::VARCHAR AS updated_at"""
MEASURES = """sum(total_amount)::DOUBLE AS total_sales,
  (sum(total_amount) - sum(commission_amount))::DOUBLE AS net_sales,
  sum(quantity)::DOUBLE AS tickets_sold,
  sum(commission_amount)::DOUBLE AS commission_amount,
  sum(commission_rate)::DOUBLE / count(*) AS avg_commission_rate,
  count(*) AS transactions"""
DAILY_TEXT = """transaction_id, event_name,
  number_of_purchased_tickets, total_amount::DOUBLE AS total_amount, sales_channel,
  customer_first_name, customer_last_name, office_location, created_date"""
STG_TICKETS = f"""ticket_id, event_id, organizer_id, reseller_id, seller_id, seller_type,
  seller_name, customer_id, sales_channel, quantity::DOUBLE AS quantity,
  unit_price::DOUBLE AS unit_price, total_amount::DOUBLE AS total_amount,
  purchase_date::VARCHAR AS purchase_date, {META}"""
ORDER_ROWS = """o_orderkey, o_custkey, o_orderstatus,
  o_totalprice::DECIMAL(18,2)::DOUBLE AS o_totalprice,
  o_orderdate::VARCHAR AS updated_at"""
# Files as exported: one per day, its reseller taken from the day.
DAY_FILE = """'DailySales_' || strftime(ts, '%m%d%Y') || '_RES'
  || lpad(day(ts)::VARCHAR, 3, '0') || '.csv'"""
LOADED = f"""trim(transaction_id)::DOUBLE AS transaction_id,
  'RES' || lpad(day(created_date::DATE)::VARCHAR, 3, '0') AS reseller_id, event_name,
  number_of_purchased_tickets::DOUBLE AS number_of_purchased_tickets,
  total_amount::DOUBLE AS total_amount, sales_channel, customer_first_name,
  customer_last_name, office_location, created_date,
  'DailySales_' || strftime(created_date::DATE, '%m%d%Y') || '_RES'
    || lpad(day(created_date::DATE)::VARCHAR, 3, '0') || '.csv' AS source_file_name,
  '2024-03-01 00:00:00' AS updated_at, '2024-03-01 00:00:00' AS load_ts,
  'GITHUB' AS source_system"""

# -- scans, sources, sinks -------------------------------------------------

_model("s01_csv_scan", """
SELECT customer_id, first_name, last_name, email, country FROM raw_customers""")
_add("s02_reseller_csv_scan", f"""
SELECT DISTINCT {DAY_FILE} AS file_name,
  'Transaction ID,Event name,Number of purchased tickets,Total amount,Sales channel,'
  || 'Customer first name,Customer last name,Office location,Created Date' AS header
FROM events""")
_model("s02_reseller_csv_rows", f"""
SELECT transaction_id, event_name, number_of_purchased_tickets::VARCHAR AS number_of_purchased_tickets,
  total_amount::VARCHAR AS total_amount, sales_channel, customer_first_name,
  customer_last_name, office_location, created_date,
  'DailySales_' || strftime(created_date::DATE, '%m%d%Y') || '_RES'
    || lpad(day(created_date::DATE)::VARCHAR, 3, '0') || '.csv' AS file_name
FROM raw_reseller_daily_sales""")
_add("s03_file_fingerprint", """
SELECT count(DISTINCT ts::DATE) AS files, count(DISTINCT ts::DATE) AS hashes,
  40 AS hash_length FROM events""")
_add("s04_positional_scan", """
SELECT ts::DATE::VARCHAR AS sale_date, 'R' || user_id AS reseller_id,
  'Seller, Ltd' AS reseller_name, 'Europe' AS reseller_region, event_id,
  'Show ' || event_id AS event_name, event_type, 5001 AS ticket_type_id,
  'VIP' AS ticket_name, 'WEB' AS sales_channel, event_id % 7 AS quantity,
  "value"::DECIMAL(12,2)::DOUBLE AS unit_price,
  "value"::DECIMAL(12,2)::DOUBLE AS gross_amount, 10.0::DOUBLE AS commission_rate,
  'someone@example.org' AS customer_email, 'USD' AS currency,
  'DailySales_' || strftime(ts, '%m%d%Y') || '_R001.csv' AS file_name,
  ts::DATE::VARCHAR AS file_sale_date,
  'BATCH_3' AS batch_id, '2024-03-01 00:00:00' AS load_ts
FROM events WHERE event_type <> 'error'""")
_add("s05_parquet_sink", """
SELECT count(*) AS rows, max(l_shipdate)::VARCHAR AS mark FROM (
  SELECT l_orderkey, l_linenumber, max(l_shipdate) AS l_shipdate
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL)""")
_model("s06_parquet_load_by_name", f"""
SELECT customer_id, first_name, last_name, email, country, {META} FROM raw_customers""")
_add("s07_table_scan", f"SELECT {ORDER_ROWS} FROM orders")
_add("s08_incremental_scan", f"""
SELECT {ORDER_ROWS} FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01'""")
_add("s09_append_sink", """
SELECT count(*) FILTER (o_orderstatus = 'F') AS first,
  count(*) FILTER (o_orderstatus <> 'F') AS second, count(*) AS stored FROM orders""")
_add("s11_truncate", """
SELECT count(*) AS rows_before, 0 AS rows_after, '1900-01-01 00:00:00' AS mark
FROM orders""")
_DATES = """SELECT date_key::VARCHAR AS date_key, year, quarter, month, month_name,
  week_number, day_of_month FROM dim_date"""
_model("s12_materialize", _DATES)

# -- projections, cleansing, filters ---------------------------------------

_model("p01_rename_columns", f"SELECT {DAILY_TEXT} FROM raw_reseller_daily_sales")
_model("p02_add_missing_columns", f"""
SELECT * REPLACE (NULL::VARCHAR AS office_location) FROM (
  SELECT {DAILY_TEXT} FROM raw_reseller_daily_sales)""")
_model("p03_conform", """
SELECT trim(transaction_id)::DOUBLE AS transaction_id, NULL::VARCHAR AS reseller_id,
  event_name, number_of_purchased_tickets::DOUBLE AS number_of_purchased_tickets,
  total_amount::DOUBLE AS total_amount, sales_channel, customer_first_name,
  customer_last_name, office_location, created_date,
  NULL::VARCHAR AS source_file_name, NULL::VARCHAR AS batch_id,
  NULL::VARCHAR AS updated_at, NULL::VARCHAR AS load_ts, NULL::VARCHAR AS source_system
FROM raw_reseller_daily_sales""")
_add("p04_stamp_metadata", """
SELECT c_custkey, c_name, 'BATCH_9' AS batch_id, '2024-03-01 00:00:00' AS load_ts,
  'GITHUB' AS source_system, 'f.csv' AS source_file_name,
  '2024-03-01 00:00:00' AS updated_at, 'RES005' AS reseller_id FROM customer""")
_model("p05_coerce_timestamps", """
SELECT event_id, try_cast(event_date AS TIMESTAMP)::VARCHAR AS event_date
FROM raw_events""")
_model("p06_stg_customers", f"""
SELECT customer_id, first_name, last_name, email, {META} FROM stg_customers""")
_model("p07_stg_events", f"""
SELECT event_id, organizer_id, event_name, event_type, venue, region,
  event_date::VARCHAR AS event_date, {META} FROM stg_events""")
_model("p08_stg_organizers", f"""
SELECT organizer_id, organizer_name, region, {META} FROM stg_organizers""")
_model("p09_stg_resellers", f"""
SELECT reseller_id, reseller_name, country, region, {META} FROM stg_resellers""")
_model("p10_stg_commissions", f"""
SELECT agreement_id::DOUBLE AS agreement_id, organizer_id, reseller_id,
  commission_rate::DOUBLE AS commission_rate, effective_from::VARCHAR AS effective_from,
  effective_to::VARCHAR AS effective_to, {META} FROM stg_commissions""")
_model("p11_stg_reseller_daily_sales", f"""
SELECT transaction_id, reseller_id, event_name,
  number_of_purchased_tickets::DOUBLE AS number_of_purchased_tickets,
  total_amount::DOUBLE AS total_amount, sales_channel, customer_first_name,
  customer_last_name, office_location, created_date::VARCHAR AS created_date,
  source_file_name, {META} FROM stg_reseller_daily_sales""")
_model("p12_stg_ticket_sales", f"SELECT {STG_TICKETS} FROM stg_ticket_sales")
_model("p13_literal_columns", """
SELECT sales_id, sales_source, ticket_id, customer_id, seller_id, seller_type
FROM int_sales WHERE sales_source = 'VENDOR PLATFORM'""")
_model("p14_coalesce_measures", """
SELECT sales_key, quantity::DOUBLE AS quantity, unit_price::DOUBLE AS unit_price,
  total_amount::DOUBLE AS total_amount, commission_rate::DOUBLE AS commission_rate
FROM fact""")
_add("p15_commission_amount", """
SELECT l_orderkey, l_linenumber, l_extendedprice::DECIMAL(18,2)::DOUBLE AS total,
  (l_discount * 100)::DECIMAL(5,2)::DOUBLE AS rate,
  round(l_extendedprice::DECIMAL(18,2) * (l_discount * 100)::DECIMAL(5,2)
    * 0.01::DECIMAL(3,2), 2)::DOUBLE AS commission_amount
FROM lineitem""")
_model("p16_comparison_filters", """
SELECT ticket_id, quantity::DOUBLE AS quantity, total_amount::DOUBLE AS total_amount,
  sales_channel
FROM stg_ticket_sales
WHERE quantity <= 0 OR total_amount < 0
  OR (quantity > 49 AND sales_channel <> 'WEB' AND purchase_date >= DATE '2000-01-01')""")
_model("p17_null_filters", """
SELECT 'direct' AS kind, ticket_id FROM stg_ticket_sales WHERE reseller_id IS NULL
UNION ALL
SELECT 'resold', ticket_id FROM stg_ticket_sales WHERE reseller_id IS NOT NULL""")
_model("p18_range_or_null", """
SELECT agreement_id::DOUBLE AS agreement_id, organizer_id, reseller_id,
  commission_rate::DOUBLE AS commission_rate
FROM stg_commissions
WHERE commission_rate < 0 OR commission_rate > 100 OR commission_rate IS NULL""")
_model("p19_not_in_list", """
SELECT ticket_id, sales_channel FROM stg_ticket_sales
WHERE sales_channel IS NULL OR sales_channel NOT IN ('WEB', 'MOBILE_APP', 'ON_SITE')""")
_add("p20_column_subset", "SELECT l_orderkey, l_suppkey AS seller FROM lineitem")

# -- scalar functions ------------------------------------------------------

_add("f01_f04_clean_text", """
SELECT p_partkey, trim('  ' || p_name || ' ') AS trimmed, upper(p_name) AS upper_name,
  lower(p_brand) AS lower_brand,
  CASE WHEN p_type <> 'PROMO' THEN p_type END AS kind, nullif(p_size, 10) AS size
FROM part""")
_add("f05_initcap", """
SELECT p_partkey, array_to_string(list_transform(
  regexp_extract_all(lower(p_name || '-' || p_type || '-' || p_brand),
    '[^ #-]+|[ #-]'), lambda p: upper(p[1]) || p[2:]), '') AS name
FROM part""")
_model("f06_f10_casts", """
SELECT event_id, form, event_date || behind AS event_date, day::VARCHAR AS event_day,
  coalesce(day, DATE '2999-12-31')::VARCHAR AS known_day,
  try_cast(p_retailprice::DECIMAL(12,4)::VARCHAR AS DECIMAL(5,2))::DOUBLE AS small_price,
  NULL::DOUBLE AS no_number, p_retailprice::DECIMAL(18,2)::DOUBLE AS price,
  day::TIMESTAMP::VARCHAR AS day_ts
FROM (
  SELECT event_id, form, behind, left(event_date, size) AS event_date,
    CASE WHEN form IN ('whole', 'timed') THEN try_cast(event_date AS DATE) END AS day
  FROM raw_events CROSS JOIN (VALUES ('whole', 10, ''), ('timed', 10, ' 10:20:30'),
    ('year', 4, ''), ('month', 7, ''), ('more', 10, ' garbage'), ('letter', 10, 'Tx'))
    AS f(form, size, behind))
  JOIN part ON event_id = 'EVT' || lpad(p_partkey::VARCHAR, 9, '0')""")
_add("f11_f13_date_parts", """
SELECT o_orderkey, year(o_orderdate) AS year, quarter(o_orderdate) AS quarter,
  month(o_orderdate) AS month, strftime(o_orderdate, '%b') AS month_name,
  weekofyear(o_orderdate) AS week_number, day(o_orderdate) AS day_of_month,
  date_trunc('week', o_orderdate)::DATE::VARCHAR AS week_start
FROM orders""")
_add("f14_f15_decimal_arithmetic", """
SELECT l_orderkey, l_linenumber,
  round(l_extendedprice::DECIMAL(18,2)
    * (1::DECIMAL(4,2) - l_discount::DECIMAL(4,2)), 2)::DOUBLE AS net,
  (l_extendedprice::DECIMAL(18,2) * 2)::DOUBLE AS twice,
  (((2 * (l_extendedprice::DECIMAL(18,2) * 100)::HUGEINT * 1000000 + l_quantity::HUGEINT)
    // (2 * l_quantity::HUGEINT))::DECIMAL(28,0) * 0.00000001::DECIMAL(9,8))::DOUBLE
    AS unit_price
FROM lineitem""")
_add("f16_f17_as_of_and_run_time", """
SELECT o_orderkey, '2024-03-01 00:00:00' AS checked_at FROM orders
WHERE o_orderdate::DATE > DATE '2000-01-01'""")
_add("f18_surrogate_key", """
SELECT md5(l_orderkey || '-' || l_linenumber || '-'
  || coalesce(nullif(l_returnflag, 'N'), '_dbt_utils_surrogate_key_null_')) AS sales_key
FROM lineitem""")
_NAMES = """SELECT event_id, CASE event_type
  WHEN 'purchase' THEN 'DailySales_' || strftime(ts, '%m%d%Y') || '_RES' || user_id || '.csv'
  WHEN 'click' THEN 'dailysales_' || strftime(ts, '%m%d%Y') || '_res' || user_id || '.CSV'
  WHEN 'view' THEN 'DailySales_' || strftime(ts, '%m%d%Y') || '_R' || user_id || '.csv'
  WHEN 'signup' THEN 'DailySales_02002020_RES' || user_id || '.csv'
  ELSE 'DailySales_' || strftime(ts, '%m%d%Y') || '_RES' || user_id || '.csv.bak' END
  AS file_name, event_type, ts, user_id FROM events"""
_add("f19_loose_file_name", f"""
SELECT event_id, file_name, CASE event_type WHEN 'view' THEN NULL
  WHEN 'click' THEN 'res' || user_id ELSE 'RES' || user_id END AS reseller_id
FROM ({_NAMES})""")
_add("f20_strict_file_name", f"""
SELECT event_id, file_name,
  CASE WHEN event_type NOT IN ('signup', 'error') THEN ts::DATE::VARCHAR END AS sale_date,
  CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN 'R' || user_id
    WHEN 'click' THEN 'res' || user_id ELSE 'RES' || user_id END AS reseller_id
FROM ({_NAMES})""")
_add("f22_to_date", """
SELECT o_orderkey, o_orderdate::DATE::VARCHAR AS day FROM orders""")
_add("f23_table_from_file", f"""
SELECT event_id, file_name, upper(replace(file_name, '.csv', '')) AS table_name
FROM ({_NAMES})""")
_add("f24_divide", """
SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN "value" / (event_id % 7) END AS share
FROM events""")

# -- joins -----------------------------------------------------------------

_model("j01_event_by_name", """
SELECT transaction_id, r.event_name, event_id, organizer_id
FROM stg_reseller_daily_sales r
  LEFT JOIN stg_events e ON upper(trim(r.event_name)) = upper(trim(e.event_name))""")
_model("j02_sale_reseller", """
SELECT ticket_id, t.reseller_id, reseller_name FROM stg_ticket_sales t
  LEFT JOIN stg_resellers r ON t.reseller_id = r.reseller_id""")
_model("j03_sale_event", """
SELECT ticket_id, t.event_id, event_name, e.organizer_id FROM stg_ticket_sales t
  LEFT JOIN stg_events e ON t.event_id = e.event_id""")
_model("j04_sale_customer", """
SELECT ticket_id, t.customer_id, first_name, last_name FROM stg_ticket_sales t
  LEFT JOIN stg_customers c ON t.customer_id = c.customer_id""")
_model("j05_effective_commission", """
SELECT sales_id, s.organizer_id, s.reseller_id, sales_date::VARCHAR AS sales_date,
  total_amount::DOUBLE AS total_amount, commission_rate::DOUBLE AS commission_rate,
  round(coalesce(total_amount, 0)::DECIMAL(18,2)
    * coalesce(commission_rate, 0)::DECIMAL(5,2) * 0.01::DECIMAL(3,2), 2)::DOUBLE
    AS commission_amount
FROM int_sales s LEFT JOIN current_agreements c
  ON s.organizer_id = c.organizer_id AND s.reseller_id = c.reseller_id
  AND sales_date BETWEEN effective_from AND coalesce(effective_to, DATE '2999-12-31')""")
_add("j05_many_periods", """
WITH p AS (
  SELECT CASE WHEN o_custkey % 3 = 0 THEN 0 ELSE o_custkey % 50 END AS pair, o_orderdate::DATE AS a,
    CASE WHEN o_orderkey % 97 = 0 THEN DATE '2999-12-31'
      ELSE o_orderdate::DATE + (o_orderkey % 40)::INT END AS z, o_orderkey % 100 AS rate
  FROM orders
), s AS (
  SELECT CASE WHEN l_partkey % 3 = 0 THEN 0 ELSE l_partkey % 50 END AS pair, l_shipdate::DATE AS day,
    count(*) AS n
  FROM lineitem GROUP BY ALL
)
SELECT s.pair::BIGINT AS pair, year(day) AS year, sum(n)::BIGINT AS rows,
  coalesce(sum(n) FILTER (rate IS NOT NULL), 0)::BIGINT AS matches, sum(n * rate)::BIGINT AS rates
FROM s LEFT JOIN p ON s.pair = p.pair AND day BETWEEN a AND z GROUP BY 1, 2""")
_model("j05_multiplied_sales", """
SELECT sales_id, sales_source, count(*) AS periods
FROM int_sales s JOIN current_agreements c
  ON s.organizer_id = c.organizer_id AND s.reseller_id = c.reseller_id
  AND sales_date BETWEEN effective_from AND coalesce(effective_to, DATE '2999-12-31')
GROUP BY ALL HAVING count(*) > 1""")
_model("w01_overlapping_agreements", """
SELECT organizer_id, reseller_id, effective_from::VARCHAR AS effective_from,
  effective_to::VARCHAR AS effective_to, commission_rate::DOUBLE AS commission_rate
FROM current_agreements a
WHERE EXISTS (SELECT 1 FROM current_agreements b
  WHERE a.organizer_id = b.organizer_id AND a.reseller_id = b.reseller_id
    AND a.effective_from <> b.effective_from
    AND a.effective_from <= coalesce(b.effective_to, DATE '2999-12-31')
    AND b.effective_from <= coalesce(a.effective_to, DATE '2999-12-31'))""")
_model("j06_event_organizer", """
SELECT event_id, e.organizer_id, organizer_name FROM stg_events e
  LEFT JOIN stg_organizers o ON e.organizer_id = o.organizer_id""")
_ORPHAN = """SELECT '{c} -> {p}' AS reference, count(*) AS orphans FROM {ct} c
  LEFT JOIN {pt} p ON c.{k} = p.{k} WHERE p.{k} IS NULL"""
_model("j07_orphan_counts", "\nUNION ALL\n".join(
    _ORPHAN.format(c=c, p=p, k=k, ct=ct, pt=f"stg_{p}")
    for c, ct, p, k in [
        ("events", "stg_events", "organizers", "organizer_id"),
        ("commission_agreements", "stg_commissions", "organizers", "organizer_id"),
        ("commission_agreements", "stg_commissions", "resellers", "reseller_id"),
        ("ticket_sales", "stg_ticket_sales", "events", "event_id"),
        ("ticket_sales", "stg_ticket_sales", "customers", "customer_id"),
        ("ticket_sales", "stg_ticket_sales", "resellers", "reseller_id"),
    ]
))
_model("j08_orphan_rows", """
SELECT ticket_id, t.reseller_id FROM stg_ticket_sales t
  LEFT JOIN stg_resellers r ON t.reseller_id = r.reseller_id
WHERE t.reseller_id IS NOT NULL AND r.reseller_id IS NULL""")
_model("j09_not_member", """
SELECT ticket_id, reseller_id FROM stg_ticket_sales t
WHERE NOT EXISTS (SELECT 1 FROM stg_resellers r WHERE r.reseller_id = t.reseller_id)""")
_PAIRS = """FROM stg_ticket_sales t JOIN stg_events e ON t.event_id = e.event_id
  LEFT JOIN stg_commissions c
    ON c.organizer_id = e.organizer_id AND c.reseller_id = t.reseller_id
WHERE c.agreement_id IS NULL"""
_model("j10_sales_without_agreement", f"""
SELECT count(*) AS sales_without_commission_agreement {_PAIRS}""")
_model("j11_pairs_without_agreement", f"""
SELECT e.organizer_id, t.reseller_id, count(*) AS sales {_PAIRS} GROUP BY ALL""")
_model("j12_labelled_revenue", """
SELECT reseller_name, sum(total_amount)::DOUBLE AS revenue
FROM stg_ticket_sales t JOIN stg_resellers r ON t.reseller_id = r.reseller_id
GROUP BY ALL""")
_STORED = """SELECT o_orderkey, o_custkey, o_orderstatus,
    o_totalprice::DECIMAL(18,2) AS o_totalprice, o_orderdate AS updated_at
  FROM orders WHERE o_orderstatus IN ('F', 'P')"""
_NEW = """SELECT o_orderkey, o_custkey, o_orderstatus,
    (o_totalprice::DECIMAL(18,2) + 1)::DECIMAL(18,2) AS o_totalprice,
    o_orderdate + to_days((o_custkey % 3 - 1)::INT) AS updated_at
  FROM orders WHERE o_orderstatus IN ('O', 'P')"""
_add("j13_merge_match", f"""
SELECT CASE WHEN t.o_orderkey IS NULL THEN 'insert' WHEN s.o_orderkey IS NULL THEN 'keep'
  ELSE 'match' END AS state, count(*) AS keys
FROM ({_STORED}) t FULL JOIN ({_NEW}) s ON t.o_orderkey = s.o_orderkey GROUP BY ALL""")

# -- aggregates, window, order, union --------------------------------------

_add("a01_count", "SELECT count(*) AS row_count FROM lineitem")
_add("a02_duplicate_keys", """
SELECT l_orderkey, l_linenumber, count(*) AS duplicate_count FROM lineitem
GROUP BY ALL HAVING count(*) > 1""")
_model("a03_min_max_date", """
SELECT 'events' AS table_name, min(event_date)::VARCHAR AS first,
  max(event_date)::VARCHAR AS last FROM stg_events
UNION ALL
SELECT 'ticket_sales', min(purchase_date)::VARCHAR, max(purchase_date)::VARCHAR
FROM stg_ticket_sales""")
_model("a04_high_water_mark", """
SELECT 'all' AS rows, max(updated_at)::VARCHAR AS updated_at FROM raw_ticket_sales
UNION ALL SELECT 'none', '1900-01-01 00:00:00'""")
_YEARS = """SELECT year({d}) AS sales_year, count(*) AS transactions,
  sum(quantity)::DOUBLE AS tickets_sold, round(sum(total_amount), 2)::DOUBLE AS revenue
FROM {t} GROUP BY 1"""
_model("a05_totals_by_year", _YEARS.format(d="purchase_date", t="stg_ticket_sales"))
_add("a06_amount_by_year", """
SELECT year(o_orderdate) AS year, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS total_amount
FROM orders GROUP BY 1""")
_add("a07_sum_by_name", """
SELECT p_name, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS revenue
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_name""")
_add("a08_distinct_rows", "SELECT DISTINCT p_brand, p_type FROM part")
_UNIQUE = """SELECT '{n}' AS check_name, CASE WHEN EXISTS
  (SELECT 1 FROM {t} GROUP BY {k} HAVING count(*) > 1) THEN 'FAIL' ELSE 'PASS' END
  AS status"""
_model("a09_is_unique", "\nUNION ALL\n".join(
    _UNIQUE.format(n=n, t=t, k=k)
    for n, t, k in [
        ("orders", "orders", "o_orderkey"), ("lineitem", "lineitem", "l_orderkey"),
        ("ticket", "stg_ticket_sales", "ticket_id"),
        ("nullable", "stg_ticket_sales", "reseller_id"),
    ]
))
_add("a10_filtered_totals", """
SELECT sum(o_totalprice::DECIMAL(18,2)) FILTER (year(o_orderdate) = 2000
    AND month(o_orderdate) = 2)::DOUBLE AS feb_2000,
  sum(o_totalprice::DECIMAL(18,2)) FILTER (year(o_orderdate) = 1999
    AND month(o_orderdate) = 2)::DOUBLE AS feb_1999
FROM orders""")
_model("a11_measures", f"SELECT {MEASURES} FROM fact")
_model("a12_row_count_and_empty", """
SELECT count(*) AS row_count, 'no' AS empty, 'yes' AS delta_empty FROM raw_ticket_sales""")
_model("a13_conditional_counts", """
SELECT count(*) FILTER (quantity <= 0) AS bad_quantity,
  count(*) FILTER (unit_price <= 0) AS bad_price,
  count(*) FILTER (sales_channel NOT IN ('WEB', 'MOBILE_APP', 'ON_SITE')) AS bad_channel,
  count(*) FILTER (round(quantity * unit_price, 2) <> total_amount) AS mismatch
FROM stg_ticket_sales""")
_model("w01_latest_version", """
SELECT * REPLACE (l_shipdate::VARCHAR AS l_shipdate) FROM latest_lines""")
_model("w01_current_agreements", """
SELECT organizer_id, reseller_id, effective_from::VARCHAR AS effective_from,
  effective_to::VARCHAR AS effective_to, commission_rate::DOUBLE AS commission_rate
FROM current_agreements""")
_add("o01_top_by_revenue", """
SELECT p_name, round(sum(l_extendedprice::DECIMAL(18,2)), 2)::DOUBLE AS revenue
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_name
ORDER BY revenue DESC, p_name LIMIT 10""")
_add("o02_order_by_group", """
SELECT year(o_orderdate) AS sales_year, count(*) AS orders FROM orders
GROUP BY 1 ORDER BY 1""")
_add("o04_existence", """
SELECT s_suppkey, s_name FROM supplier WHERE EXISTS (
  SELECT 1 FROM lineitem WHERE l_suppkey = s_suppkey AND l_returnflag = 'R')""")
_model("u01_union_of_feeds", """
SELECT sales_id, sales_source, quantity::DOUBLE AS quantity,
  unit_price::DOUBLE AS unit_price, total_amount::DOUBLE AS total_amount,
  sales_date::VARCHAR AS sales_date FROM int_sales""")
_COUNT = "SELECT '{n}' AS table_name, count(*) AS row_count FROM {t}"
_add("u02_labelled_counts", "\nUNION ALL\n".join(
    _COUNT.format(n=t, t=t) for t in ("nation", "supplier", "part", "orders", "lineitem")
))

# -- incremental load, upsert, ledgers -------------------------------------

_add("i01_get_watermark", """
SELECT max(o_orderdate)::VARCHAR AS orders, '1900-01-01 00:00:00' AS absent FROM orders""")
_MARK = """SELECT '{n}' AS source_table, max(updated_at)::VARCHAR AS last_updated_at,
  '2024-03-01 00:00:00' AS updated_ts, 'B1' AS batch_id FROM raw_{n}"""
_model("i02_update_watermark", "\nUNION ALL\n".join(
    _MARK.format(n=n)
    for n in ("organizers", "customers", "ticket_sales", "reseller_daily_sales")
))
_model("i03_incremental_staging", f"SELECT {STG_TICKETS} FROM stg_ticket_sales")


def _merge(guard: str) -> str:
    picked = ", ".join(
        f"CASE WHEN {'s.o_orderkey IS NOT NULL' if c == 'o_orderkey' else 'use_new'} "
        f"THEN s.{c} ELSE t.{c} END{cast} AS {c}"
        for c, cast in [
            ("o_orderkey", ""), ("o_custkey", ""), ("o_orderstatus", ""),
            ("o_totalprice", "::DOUBLE"), ("updated_at", "::VARCHAR"),
        ]
    )
    use = f"s.o_orderkey IS NOT NULL AND (t.o_orderkey IS NULL OR {guard})"
    return f"""
SELECT {picked.replace('use_new', use)}
FROM ({_STORED}) t FULL JOIN ({_NEW}) s ON t.o_orderkey = s.o_orderkey"""


_add("i04_upsert", _merge("true"))
_add("i04_upsert_guarded", _merge("s.updated_at > t.updated_at"))
_add("i04_upsert_versioned_table", _merge("s.updated_at > t.updated_at"))
_model("i05_incremental_fact", f"""
SELECT {FACT} FROM fact WHERE sales_source = 'B2B PLATFORM'""")
_model("i05_shared_mark_loses_late_rows", f"""
SELECT {FACT} FROM fact
WHERE source_system = 'GITHUB' OR updated_at <= TIMESTAMP '1999-01-01'""")
_model("i05_mark_per_feed", f"SELECT {FACT} FROM fact")
_add("i05_schema_sync", f"""
SELECT * , CASE WHEN o_orderstatus IN ('O', 'P') THEN 'NEW' END AS priority
FROM ({_merge("true")})""")
# Sales that are one row of the fact.
SINGLE = """FROM fact WHERE sales_key NOT IN (
  SELECT sales_key FROM fact GROUP BY sales_key HAVING count(*) > 1)"""
_model("i05_both_feeds_stored_target", f"""
SELECT * EXCLUDE (updated_at) FROM (SELECT {FACT} {SINGLE})""")
_model("i05_rerated_fact", f"SELECT {FACT} FROM fact")
_model("i06_merges_by_name", " UNION ALL ".join(
    f"""SELECT '{t}' AS table_name, count(*) AS keys,
  count(*) FILTER (ascii(right({ks[-1]}, 1)) % 3 = 1) AS updated
FROM (SELECT DISTINCT {", ".join(ks)} FROM raw_{t}
  WHERE {" AND ".join(f"{k} IS NOT NULL" for k in ks)})"""
    for t, (ks, _) in schemas.VARIANT_KEYS.items()
))
_model("i13_one_commit", " UNION ALL ".join(
    f"""SELECT '{step}' AS step, '{t}' AS table_name, count(*) AS rows FROM stg_{t}
WHERE {"true" if step == "repeated" else f"ascii(right({k}, 1)) % 2 = 0"}"""
    for step in ("died", "repeated")
    for t, k in (("organizers", "organizer_id"), ("resellers", "reseller_id"), ("events", "event_id"))
))
_model("i06_merge_by_name", """
SELECT max(agreement_id)::DOUBLE AS agreement_id, organizer_id, reseller_id,
  arg_max(commission_rate, agreement_id)::DOUBLE AS commission_rate,
  arg_max(updated_at, agreement_id)::VARCHAR AS updated_at
FROM stg_commissions GROUP BY organizer_id, reseller_id""")
_add("i08_unseen_files", """
SELECT DISTINCT 'DailySales_' || strftime(ts, '%m%d%Y') || '_RES'
  || lpad(user_id::VARCHAR, 9, '0') || '.csv' AS file_name
FROM events WHERE ts::DATE >= DATE '2024-01-10'""")
_add("i09_file_history", f"""
SELECT {DAY_FILE} AS file_name, '2024-03-01 00:00:00' AS load_date,
  count(*) AS record_count, 'SUCCESS' AS status, NULL::VARCHAR AS error_message
FROM events GROUP BY 1""")
_STRANGE = f"""if(day(ts) <= 5, replace({DAY_FILE}, 'DailySales_', 'Sales_'), {DAY_FILE})"""
_add("i09_failed_files", f"""
SELECT {_STRANGE} AS file_name, '2024-03-01 00:00:00' AS load_date,
  CASE WHEN day(ts) <= 5 THEN 0 ELSE count(*) END AS record_count,
  CASE WHEN day(ts) <= 5 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
  CASE WHEN day(ts) <= 5 THEN 'Invalid file name: ' || {_STRANGE} END AS error_message
FROM events GROUP BY {_STRANGE}, day(ts)""")
_model("i10_load_files", f"""
SELECT {LOADED}, 'BATCH_3' AS batch_id FROM raw_reseller_daily_sales""")
_model("i10_stream_files", f"SELECT {LOADED} FROM raw_reseller_daily_sales")
_add("i11_job_audit", """
SELECT 'load_files' AS job_name, '2024-03-01 00:00:00' AS start_time,
  'SUCCESS' AS status, count(*) AS records_loaded,
  count(DISTINCT ts::DATE) AS files_processed, NULL::VARCHAR AS error_message
FROM events""")
_model("i12_full_reload", "\nUNION ALL\n".join(
    f"""SELECT '{n}' AS table_name, count(*) AS loaded, 0 AS loaded_again, 0 AS after_reset,
  count(*) AS reloaded, count(*) AS stored FROM raw_{n}"""
    for n in ("organizers", "resellers", "commission_agreements", "events", "customers",
              "ticket_sales", "reseller_daily_sales")
))
_model("i13_load_then_marks", "\nUNION ALL\n".join(
    f"""SELECT '{n}' AS source_table, max(updated_at)::VARCHAR AS last_updated_at,
  count(*) AS row_count FROM raw_{n}"""
    for n in ("organizers", "resellers", "commission_agreements", "events", "customers",
              "ticket_sales")
))

# -- data quality ----------------------------------------------------------

_SQL_NAMES = {"int_sales_transactions": "int_sales", "fact_ticket_sales": "fact"}


def _log(checks: list[tuple[str, str, str]]) -> str:
    """Check name, table and a query of the failures, as one check log."""
    rows = "\nUNION ALL\n".join(
        f"SELECT '{n}' AS check_name, '{t}' AS table_name, ({q}) AS failed_count"
        for n, t, q in checks
    )
    return f"""SELECT check_name, table_name,
  CASE WHEN failed_count = 0 THEN 'PASS' ELSE 'FAIL' END AS status, failed_count
FROM ({rows})"""


def _name(t: str) -> str:
    return _SQL_NAMES.get(t, t)


def _rows(t: str, where: str) -> str:
    return f"SELECT count(*) FROM {_name(t)} WHERE {where}"


def _repeated(t: str, c: str, where: str = "true") -> str:
    return f"""SELECT count(*) FROM (SELECT {c} FROM {_name(t)} WHERE {where}
    GROUP BY {c} HAVING count(*) > 1)"""


def _unknown(t: str, c: str, p: str, nulls: bool = False) -> str:
    kept = "true" if nulls else f"c.{c} IS NOT NULL"
    return f"""SELECT count(*) FROM {_name(t)} c
    WHERE {kept} AND NOT EXISTS (SELECT 1 FROM {p} p WHERE p.{c} = c.{c})"""


_model("q01_unique", _log([
    (f"unique({c})", t, _repeated(t, c, f"{c} IS NOT NULL"))
    for t, cs in quality.UNIQUE.items() for c in cs
]))
_model("q01_q04_standing_checks", _log([
    ("unique(event_id)", "sales", _repeated("stg_ticket_sales", "event_id", "event_id IS NOT NULL")),
    ("relationships(reseller_id -> resellers)", "sales",
     """SELECT count(*) FROM stg_ticket_sales s WHERE reseller_id IS NOT NULL AND NOT EXISTS (
        SELECT 1 FROM stg_resellers r WHERE r.reseller_id = s.reseller_id
          AND ascii(right(r.reseller_id, 1)) % 2 = 0)"""),
    ("relationships(event_id -> events)", "sales", _unknown("stg_ticket_sales", "event_id", "stg_events", True)),
]))
_model("q02_not_null", _log([
    (f"not_null({c})", t, _rows(t, f"{c} IS NULL"))
    for t, cs in quality.NOT_NULL.items() for c in cs
]))
_model("q03_accepted_values", _log([
    (f"accepted_values({c})", t,
     _rows(t, f"{c} NOT IN ({', '.join(repr(v) for v in vs)})"))
    for t, c, vs in quality.ACCEPTED
]))
_model("q04_relationships", _log([
    (f"relationships({c} -> {p})", t, _unknown(t, c, p)) for t, c, p in quality.RELATED
]))
_model("q05_duplicate_sales", """
SELECT sales_id, count(*) AS duplicate_count FROM int_sales
WHERE sales_id IS NOT NULL GROUP BY sales_id HAVING count(*) > 1""")
_model("q06_negative_amount", """
SELECT sales_id, ticket_id, transaction_id, total_amount::DOUBLE AS total_amount,
  source_system FROM int_sales WHERE total_amount < 0""")
_model("q07_quantity_not_positive", """
SELECT sales_id, ticket_id, transaction_id, quantity::DOUBLE AS quantity,
  source_system FROM int_sales WHERE quantity <= 0""")
_model("q08_future_sales", """
SELECT sales_id, sales_date::VARCHAR AS sales_date FROM int_sales
WHERE sales_date > DATE '2001-01-01'""")
_model("q09_commission_rate_range", _log([
    ("null_is_bad", "stg_commissions", _rows("stg_commissions",
     "commission_rate < 0 OR commission_rate > 100 OR commission_rate IS NULL")),
    ("null_passes", "stg_commissions", _rows("stg_commissions",
     "commission_rate < 0 OR commission_rate > 100")),
]))
_model("q10_amount_mismatch", """
SELECT ticket_id, quantity::DOUBLE AS quantity, unit_price::DOUBLE AS unit_price,
  total_amount::DOUBLE AS total_amount
FROM stg_ticket_sales WHERE round(quantity * unit_price, 2) <> total_amount""")


def _outside(t: str, c: str, first: str, last: str) -> str:
    return _rows(f"stg_{t}", f"{c} < DATE '{first}' OR {c} > DATE '{last}'")


_model("q11_price_and_date_bounds", _log([
    ("unit_price_positive", "ticket_sales", _rows("stg_ticket_sales", "unit_price <= 0")),
    ("event_date_range", "events",
     _outside("events", "event_date", "1995-06-01", "2001-06-30")),
    ("purchase_date_range", "ticket_sales",
     _outside("ticket_sales", "purchase_date", "1995-06-01", "2001-06-30")),
]))
_CRITICAL = [
    (f"not_null({c})", "ticket_sales", _rows("stg_ticket_sales", f"{c} IS NULL"))
    for c in ("event_id", "customer_id", "reseller_id")
]
_model("q12_null_critical_fields", _log(_CRITICAL))
_STG = {"commission_agreements": "stg_commissions"}
_model("q13_source_report", _log([
    *[("nonempty", t,
       f"SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM {_STG.get(t, 'stg_' + t)}")
      for t in ("organizers", "resellers", "commission_agreements", "events", "customers",
                "ticket_sales")],
    *[(f"unique({c})", t, _repeated(f"stg_{t}", c))
      for t, c in [("organizers", "organizer_id"), ("resellers", "reseller_id"),
                   ("events", "event_id"), ("customers", "customer_id"),
                   ("ticket_sales", "ticket_id")]],
    *[(f"relationships({c} -> {p})", t,
       _unknown(_STG.get(t, f"stg_{t}"), c, f"stg_{p}", True))
      for t, c, p in [("events", "organizer_id", "organizers"),
                      ("commission_agreements", "organizer_id", "organizers"),
                      ("commission_agreements", "reseller_id", "resellers"),
                      ("ticket_sales", "event_id", "events"),
                      ("ticket_sales", "customer_id", "customers"),
                      ("ticket_sales", "reseller_id", "resellers")]],
    ("relationships(events.organizer_id, reseller_id -> commission_agreements)", "ticket_sales",
     """SELECT count(*) FROM stg_ticket_sales s JOIN stg_events e USING (event_id)
        WHERE s.reseller_id IS NULL OR e.organizer_id IS NULL
          OR (e.organizer_id, s.reseller_id) NOT IN (
            SELECT (organizer_id, reseller_id) FROM stg_commissions
            WHERE organizer_id IS NOT NULL AND reseller_id IS NOT NULL)"""),
    ("event_date_range", "events",
     _outside("events", "event_date", "1995-01-01", "2001-08-01")),
    ("purchase_date_range", "ticket_sales",
     _outside("ticket_sales", "purchase_date", "1995-01-01", "2001-08-01")),
    ("commission_rate_range", "commission_agreements",
     _rows("stg_commissions", "commission_rate < 0 OR commission_rate > 100")),
    ("quantity_positive", "ticket_sales", _rows("stg_ticket_sales", "quantity <= 0")),
    ("unit_price_positive", "ticket_sales", _rows("stg_ticket_sales", "unit_price <= 0")),
    ("accepted_values(sales_channel)", "ticket_sales", _rows("stg_ticket_sales",
     "sales_channel IS NULL OR sales_channel NOT IN ('WEB', 'MOBILE_APP', 'ON_SITE')")),
    ("amount_matches", "ticket_sales", _rows("stg_ticket_sales",
     "round(quantity * unit_price, 2) <> total_amount")),
    *_CRITICAL,
]))
_CHANNEL = "sales_channel IN ('WEB', 'MOBILE_APP', 'ON_SITE')"
_model("q16_write_audit_publish", f"""
SELECT 'refused' AS step, sales_channel, count(*) AS sales FROM stg_ticket_sales
WHERE {_CHANNEL} GROUP BY ALL
UNION ALL
SELECT 'mended', CASE WHEN {_CHANNEL} THEN sales_channel ELSE 'WEB' END, count(*)
FROM stg_ticket_sales GROUP BY ALL""")
_add("q14_rejects", """
SELECT 'BATCH_3' AS batch_id, 'reseller_exports' AS source_name,
  'bad quantity' AS reason, '2024-03-01 00:00:00' AS rejected_at, event_id,
  'Seller, Ltd' AS reseller_name
FROM events WHERE event_type = 'error'""")
_model("q15_check_log", "SELECT 'B1' AS batch_id, *, '2024-03-01 00:00:00' AS checked_at FROM (" + _log([
    ("accepted_values(sales_channel)", "ticket_sales", _rows("stg_ticket_sales",
     "sales_channel NOT IN ('WEB', 'MOBILE_APP', 'ON_SITE')")),
    ("not_null(event_date)", "events", _rows("stg_events", "event_date IS NULL")),
]) + ")")
_model("q16_gate", """
SELECT 'stop' AS outcome, 1 AS failed_checks, count(*) AS failed_rows
FROM stg_ticket_sales WHERE sales_channel NOT IN ('WEB', 'MOBILE_APP', 'ON_SITE')""")

# -- models and reports ----------------------------------------------------

_model("m01_int_sales_transactions", f"SELECT {SALES} FROM int_sales")
_model("m02_fact_ticket_sales", f"SELECT {FACT} FROM fact")
_model("m03_dim_customer", "SELECT * FROM dim_customer")
_model("m03_dim_reseller", "SELECT * FROM dim_reseller")
_model("m03_dim_organizer", "SELECT * FROM dim_organizer")
_model("m04_dim_event", """
SELECT * REPLACE (event_date::VARCHAR AS event_date) FROM dim_event""")
_model("m05_dim_date", _DATES)
_model("r01_weekly_kept_up_to_date", f"""
SELECT date_trunc('week', sales_date)::DATE::VARCHAR AS week, sales_channel, {MEASURES}
{SINGLE} GROUP BY 1, 2""")
_model("r01_weekly_by_channel", f"""
SELECT date_trunc('week', sales_date)::DATE::VARCHAR AS week, sales_channel, {MEASURES}
FROM fact GROUP BY 1, 2""")
_model("r02_february_comparison", """
SELECT a::DOUBLE AS current_sales, b::DOUBLE AS base_sales, (a - b)::DOUBLE AS difference,
  (a - b)::DOUBLE / b::DOUBLE AS change_share
FROM (SELECT sum(total_amount) FILTER (year(sales_date) = 2000 AND month(sales_date) = 2) AS a,
  sum(total_amount) FILTER (year(sales_date) = 1999 AND month(sales_date) = 2) AS b
  FROM fact)""")
_model("r03_by_reseller_and_event_type", f"""
SELECT f.reseller_id, reseller_name, event_type, {MEASURES}
FROM fact f JOIN dim_event e ON f.event_id = e.event_id
  JOIN dim_reseller r ON f.reseller_id = r.reseller_id
GROUP BY ALL""")
_model("r03_chosen_resellers_and_types", f"""
SELECT f.reseller_id, reseller_name, event_type, {MEASURES}
FROM fact f JOIN dim_event e ON f.event_id = e.event_id
  JOIN dim_reseller r ON f.reseller_id = r.reseller_id
WHERE f.reseller_id IN ('RES000000001', 'RES000000002', 'RES000000003', 'RES000000004')
  AND (SELECT count(DISTINCT event_type) FROM dim_event k WHERE k.event_type < e.event_type) < 3
GROUP BY ALL""")
_model("r04_commission_bands", f"""
SELECT floor(commission_rate)::INT AS rate_band, {MEASURES} FROM fact GROUP BY 1""")
_model("r04_commission_by_reseller", f"""
SELECT reseller_id, {MEASURES} FROM fact WHERE reseller_id IS NOT NULL GROUP BY 1""")
_model("r05_popular_by_region", """
SELECT region, f.event_id, event_name, sum(quantity)::DOUBLE AS tickets_sold,
  row_number() OVER (PARTITION BY region ORDER BY sum(quantity) DESC, f.event_id) AS rank
FROM fact f JOIN dim_event e ON f.event_id = e.event_id
GROUP BY region, f.event_id, event_name QUALIFY rank <= 5""")
_model("r06_revenue_by_year", _YEARS.format(d="sales_date", t="fact"))
_model("r07_top_events", """
SELECT event_name, round(sum(total_amount), 2)::DOUBLE AS revenue
FROM stg_ticket_sales t JOIN stg_events e ON t.event_id = e.event_id
GROUP BY event_name ORDER BY revenue DESC, event_name LIMIT 10""")
_model("r07_top_resellers", """
SELECT reseller_name, round(sum(total_amount), 2)::DOUBLE AS revenue
FROM stg_ticket_sales t JOIN stg_resellers r ON t.reseller_id = r.reseller_id
GROUP BY reseller_name ORDER BY revenue DESC, reseller_name LIMIT 10""")
_model("r08_by_seller_type", f"""
SELECT seller_type, sales_channel, {MEASURES} FROM fact GROUP BY 1, 2""")
_model("r08_top_customers", f"""
SELECT f.customer_id, email, {MEASURES}
FROM fact f JOIN dim_customer c ON f.customer_id = c.customer_id
GROUP BY 1, 2 ORDER BY sum(total_amount) DESC, f.customer_id, email LIMIT 20""")
_model("r08_by_reseller_location", f"""
SELECT region, country, {MEASURES}
FROM fact f JOIN dim_reseller r ON f.reseller_id = r.reseller_id GROUP BY 1, 2""")
_model("r08_by_event_type", f"""
SELECT event_type, {MEASURES}
FROM fact f JOIN dim_event e ON f.event_id = e.event_id
WHERE region <> 'ASIA' GROUP BY 1""")
_model("r09_measures_by_year", f"""
SELECT year, {MEASURES} FROM fact JOIN dim_date ON sales_date = date_key GROUP BY 1""")
_model("r10_row_counts", "\nUNION ALL\n".join(
    _COUNT.format(n=t, t=f"raw_{t}")
    for t in ("organizers", "resellers", "customers", "events", "commission_agreements",
              "ticket_sales", "reseller_daily_sales")
))
