"""The registered queries once more, as SQL for an independent engine.

Views are common table expressions over the given tables; a query names the last one
it needs and gets all that lead to it.
"""

from __future__ import annotations

_VIEWS = {
    "raw_order_items": """
        SELECT l_orderkey AS order_id, l_partkey AS product_id FROM lineitem""",
    "raw_customers": """
        SELECT CAST(c_custkey AS varchar) AS customer_id,
          '  ' || c_name || CASE WHEN copy = 1 THEN ' v2' ELSE '' END || ' ' AS customer_name,
          'Company ' || CAST(c_custkey % 50 AS varchar) AS company,
          CAST(c_custkey AS varchar) || ' Main St' AS shipping_address,
          CAST(10000 + c_custkey % 90000 AS varchar) AS zipcode,
          ' city ' || CAST(c_nationkey AS varchar) AS city,
          ' ' || lower(c_mktsegment) || ' ' AS state,
          ' ' || lower(n_name) AS country,
          CASE WHEN c_custkey % 211 = 0 THEN 'not-a-date' ELSE
            CAST(DATE '1950-01-01' + CAST(c_custkey * 37 % 18000 AS int) AS varchar) END AS dob,
          ' user' || CAST(c_custkey AS varchar) || '@mail.example ' AS email,
          CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
          n_name AS nationality,
          '+1-555-' || CAST(1000 + c_custkey % 9000 AS varchar) AS phone,
          'user' || CAST(c_custkey AS varchar) AS username,
          CASE WHEN c_custkey % 101 = 0 THEN NULL
            ELSE CAST(4000000000000000 + c_custkey * 7919 AS varchar) END AS credit_card_no,
          CASE WHEN c_custkey % 3 = 0 THEN 'visa' ELSE 'other' END AS credit_card_type,
          CASE WHEN c_custkey % 50 = 0 THEN 'no-at-sign'
            ELSE 'user' || CAST(c_custkey AS varchar) || '@pay.example' END AS paypal_account
        FROM customer JOIN nation ON c_nationkey = n_nationkey
          JOIN (VALUES (0), (1)) AS twice(copy) ON copy = 0 OR c_custkey % 97 = 0""",
    "raw_sellers": """
        SELECT CAST(s_suppkey AS varchar) AS seller_id,
          ' ' || CAST(s_suppkey AS varchar) || ' Dock Rd ' AS seller_address,
          ' s' || CAST(s_suppkey % 7 AS varchar) || ' ' AS seller_state,
          CAST(20000 + s_suppkey AS varchar) AS seller_zipcode,
          ' ' || lower(n_name) AS seller_country,
          CASE WHEN s_suppkey % 17 = 0 THEN 'n/a'
            ELSE CAST(s_suppkey % 5 + 1 AS varchar) END AS seller_rating,
          CASE WHEN s_suppkey % 19 = 0 THEN '' ELSE
            CAST(DATE '2010-01-01' + CAST(s_suppkey * 13 % 4000 AS int) AS varchar)
            END AS seller_active_date,
          CASE WHEN s_suppkey % 2 = 0 THEN 'retail' ELSE 'wholesale' END AS seller_business_type,
          ' ' || s_name || CASE WHEN copy = 1 THEN ' v2' ELSE '' END || ' ' AS seller_company_name
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
          JOIN (VALUES (0), (1)) AS twice(copy) ON copy = 0 OR s_suppkey % 20 = 0""",
    "first_seller": """
        SELECT l_orderkey, min(l_suppkey) AS seller_id FROM lineitem GROUP BY l_orderkey""",
    "raw_orders": f"""
        SELECT md5(CAST(o_orderkey AS varchar)) AS order_id, o_custkey AS customer_id, seller_id,
          CAST(o_orderdate AS timestamp) AS order_date, o_totalprice AS order_total_price,
          o_orderpriority AS payment_method
        FROM orders LEFT JOIN first_seller ON l_orderkey = o_orderkey
        WHERE o_orderdate < TIMESTAMP '2000-01-01'""",
    "raw_orders_new": f"""
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, seller_id,
          CAST(o_orderdate AS date) AS order_date, o_orderpriority AS payment_method
        FROM orders LEFT JOIN first_seller ON l_orderkey = o_orderkey
          JOIN (VALUES (0), (1)) AS twice(copy) ON copy = 0 OR o_orderkey % 3 = 0
        WHERE o_orderdate >= TIMESTAMP '2000-01-01'""",
    "clean_order_items": """
        SELECT DISTINCT order_id, product_id, 'bronze.order_items' AS data_source
        FROM raw_order_items""",
    "kept_customers": """
        SELECT * EXCLUDE (rank) FROM (
          SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY customer_name) AS rank
          FROM raw_customers) WHERE rank = 1""",
    "masks": r"""
        SELECT customer_id,
          CASE WHEN length(credit_card_no) > 4
            THEN repeat('*', CAST(length(credit_card_no) - 4 AS int)) || right(credit_card_no, 4)
            ELSE credit_card_no END AS card,
          CASE WHEN paypal_account NOT LIKE '%@%' OR strpos(paypal_account, '@') <= 4
            THEN paypal_account
            ELSE left(paypal_account, 3)
              || repeat('*', CAST(strpos(paypal_account, '@') - 4 AS int))
              || substr(paypal_account, strpos(paypal_account, '@')) END AS account
        FROM kept_customers""",
    "clean_customers": """
        SELECT k.customer_id, trim(customer_name) AS customer_name, company, shipping_address,
          zipcode, trim(city) AS city, upper(trim(state)) AS state,
          upper(trim(country)) AS country, TRY_CAST(dob AS date) AS dob, trim(email) AS email,
          gender, nationality, phone, username, card AS credit_card_no, credit_card_type,
          account AS paypal_account, 'bronze.customers' AS data_source
        FROM kept_customers k JOIN masks m ON k.customer_id = m.customer_id""",
    "clean_sellers": """
        SELECT seller_id, trim(seller_address) AS seller_address,
          upper(trim(seller_state)) AS seller_state, seller_zipcode,
          upper(trim(seller_country)) AS seller_country,
          TRY_CAST(seller_rating AS double) AS seller_rating,
          TRY_CAST(seller_active_date AS date) AS seller_active_date, seller_business_type,
          trim(seller_company_name) AS seller_company_name, 'bronze.sellers' AS data_source
        FROM (SELECT *, row_number() OVER (
            PARTITION BY seller_id ORDER BY seller_company_name) AS rank FROM raw_sellers)
        WHERE rank = 1""",
    "clean_orders_legacy": """
        SELECT DISTINCT order_id, CAST(customer_id AS varchar) AS customer_id,
          CAST(seller_id AS varchar) AS seller_id, order_date, order_total_price, payment_method,
          'legacy' AS source_system, 'bronze.orders' AS data_source
        FROM raw_orders""",
    "clean_orders_new": """
        SELECT DISTINCT CAST(order_id AS varchar) AS order_id,
          CAST(customer_id AS varchar) AS customer_id, CAST(seller_id AS varchar) AS seller_id,
          CAST(order_date AS timestamp) AS order_date, CAST(NULL AS double) AS order_total_price,
          payment_method, 'new_system' AS source_system, 'bronze.orders_new' AS data_source
        FROM raw_orders_new""",
    "unified": """
        SELECT * FROM clean_orders_legacy UNION ALL BY NAME SELECT * FROM clean_orders_new""",
    "dim_customers": """
        SELECT customer_id AS customer_key, customer_id, customer_name, email, phone, gender, dob,
          CAST(2025 - year(dob) AS int) AS age, nationality, city, state, country, zipcode,
          company, data_source
        FROM clean_customers""",
    "dim_date": f"""
        SELECT day AS date_key, day AS date, CAST(year(day) AS int) AS year,
          CAST(quarter(day) AS int) AS quarter, CAST(month(day) AS int) AS month,
          CAST(day(day) AS int) AS day, CAST(dayofweek(day) + 1 AS int) AS day_of_week,
          CAST(weekofyear(day) AS int) AS week_of_year, monthname(day) AS month_name,
          dayname(day) AS day_name, dayofweek(day) IN (0, 6) AS is_weekend,
          month(day) IN (12, 1, 2) AS is_winter, month(day) IN (3, 4, 5) AS is_spring,
          month(day) IN (6, 7, 8) AS is_summer, month(day) IN (9, 10, 11) AS is_fall,
          CAST(CASE WHEN month(day) >= 7 THEN year(day) + 1 ELSE year(day) END AS int)
            AS fiscal_year
        FROM (SELECT CAST(unnest(generate_series(
            date_trunc('year', first), date_trunc('year', last) + INTERVAL 1 YEAR
              - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS date) AS day
          FROM (SELECT CAST(min(o_orderdate) AS timestamp) AS first,
            CAST(max(o_orderdate) AS timestamp) AS last FROM orders))""",
    "fact_orders": """
        SELECT order_id AS order_key, customer_id AS customer_key, seller_id AS seller_key,
          CAST(order_date AS date) AS order_date_key, payment_method, source_system,
          coalesce(order_total_price, 0.0) AS order_amount,
          order_total_price IS NULL AS is_amount_missing
        FROM unified""",
    "fact_sales_summary": """
        SELECT customer_id AS customer_key, seller_id AS seller_key,
          CAST(order_date AS date) AS order_date_key, count(*) AS order_count,
          CAST(sum(CAST(order_total_price AS decimal(18,2))) AS double) AS total_revenue,
          CAST(sum(CAST(order_total_price AS decimal(18,2))) AS double)
            / count(order_total_price) AS avg_order_value,
          min(order_total_price) AS min_order_value, max(order_total_price) AS max_order_value
        FROM unified WHERE source_system = 'legacy' GROUP BY ALL""",
    "uneven": """
        SELECT CASE WHEN o_custkey % 10 < 6 THEN 'HOT' ELSE o_orderpriority END AS partition,
          count(*) AS row_count
        FROM orders GROUP BY ALL""",
    "feed": """
        SELECT customer_id, customer_name, state, trim(state) AS segment, c_acctbal < 0 AS owes
        FROM kept_customers JOIN customer ON customer_id = CAST(c_custkey AS varchar)""",
    "first_feed": """
        SELECT customer_id, customer_name, state FROM feed WHERE segment <> 'building'""",
    "second_feed": """
        SELECT customer_id, customer_name,
          CASE WHEN owes THEN state || '-MOVED' ELSE state END AS state
        FROM feed WHERE segment <> 'machinery'""",
    "new_slots": """
        SELECT *, CAST('0x' || substr(md5(CAST(order_id AS varchar)), 1, 5) AS int) AS slot
        FROM raw_orders_new""",
    "estimates": """
        SELECT 'duplicate_rows' AS metric, count(*) - count(DISTINCT order_id) AS exact,
          count(*) FILTER (slot < 262144)
            - count(DISTINCT order_id) FILTER (slot < 262144) AS sampled
        FROM new_slots
        UNION ALL
        SELECT 'nulls:seller_id', count(*) FILTER (seller_id IS NULL),
          count(*) FILTER (seller_id IS NULL AND slot < 262144)
        FROM new_slots""",
}


def _sql(body: str) -> str:
    """The query with the views it needs, in the order they build on each other."""
    needed: set[str] = set()
    pending = [body]
    while pending:
        text = pending.pop()
        for name in _words(text) & _VIEWS.keys() - needed:
            needed.add(name)
            pending.append(_VIEWS[name])
    views = ", ".join(f"{name} AS ({sql})" for name, sql in _VIEWS.items() if name in needed)
    return f"WITH {views} {body}" if views else body


def _words(text: str) -> set[str]:
    return set("".join(c if c.isalnum() or c == "_" else " " for c in text).split())


def _counts(label: str, tables: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS {label}, count(*) AS n FROM {view}" for name, view in tables.items()
    )


_RAW_TABLES = ("order_items", "customers", "sellers", "orders", "orders_new")
_RAW = {name: f"raw_{name}" for name in _RAW_TABLES}

_RAW_CUSTOMER_COLUMNS = (
    "customer_id customer_name company shipping_address zipcode city state country dob email"
    " gender nationality phone username credit_card_no credit_card_type paypal_account"
).split()


def _nulls() -> str:
    return " UNION ALL ".join(
        f'SELECT \'{c}\' AS "column", count(*) - count({c}) AS null_count,'
        f" (count(*) - count({c})) * 100e0 / count(*) AS null_pct FROM raw_customers"
        for c in _RAW_CUSTOMER_COLUMNS
    )


_MEASURES = {
    "n": "count({c})",
    "mean": "avg({c})",
    "stddev": "stddev_samp({c})",
    "min": "min({c})",
    "max": "max({c})",
    "negatives": "count(*) FILTER ({c} < 0)",
}


def _ranges(c: str, table: str) -> str:
    measures = {**_MEASURES, "mean": "round(avg({c}), 4)", "stddev": "round(stddev_samp({c}), 4)"}
    columns = ", ".join(f"{sql.format(c=c)} AS {name}" for name, sql in measures.items())
    return f"SELECT '{c}' AS \"column\", {columns} FROM {table}"


def _report() -> str:
    def cell(check: str, column: str, metric: str, value: str, table: str) -> str:
        return (
            f"SELECT '{check}' AS \"check\", '{column}' AS \"column\", '{metric}' AS metric,"
            f" round(CAST({value} AS double), 4) AS value FROM {table}"
        )

    raw = "raw_orders_new"
    cells = []
    for c in ("order_id", "customer_id", "seller_id", "order_date", "payment_method"):
        cells.append(cell("nulls", c, "null_count", f"count(*) - count({c})", raw))
        share = f"(count(*) - count({c})) * 100e0 / count(*)"
        cells.append(cell("nulls", c, "null_pct", share, raw))
    for c in ("order_id", "customer_id", "seller_id"):
        for metric, sql in _MEASURES.items():
            cells.append(cell("ranges", c, metric, sql.format(c=c), raw))
    for metric, sql in {
        "total_rows": "count(*)",
        "unique_rows": "count(DISTINCT order_id)",
        "duplicate_rows": "count(*) - count(DISTINCT order_id)",
        "duplicate_pct": "(count(*) - count(DISTINCT order_id)) * 100e0 / count(*)",
    }.items():
        cells.append(cell("duplicates", "order_id", metric, sql, raw))
    sizes = f"(SELECT count(*) AS n FROM {raw} GROUP BY payment_method)"
    for metric, sql in {
        "partitions": "count(*)",
        "max": "max(n)",
        "min": "min(n)",
        "mean": "avg(n)",
        "median": "median(n)",
        "skew_factor": "max(n) / median(n)",
    }.items():
        cells.append(cell("skew", "payment_method", metric, sql, sizes))
    return " UNION ALL ".join(cells)


def _ltv(condition: str) -> str:
    return f"""
        SELECT f.customer_key, customer_name, country,
          CAST(sum(CAST(order_amount AS decimal(18,2))) AS double) AS lifetime_value,
          count(order_key) AS total_orders
        FROM fact_orders f JOIN dim_customers c ON f.customer_key = c.customer_key
        WHERE {condition} GROUP BY ALL ORDER BY lifetime_value DESC, f.customer_key LIMIT 10"""


_MERGED_FEEDS = """
    SELECT * FROM first_feed WHERE customer_id NOT IN (SELECT customer_id FROM second_feed)
    UNION ALL SELECT * FROM second_feed"""

_SCD1 = """
    SELECT coalesce(b.customer_id, a.customer_id) AS customer_id,
      CASE WHEN b.customer_id IS NULL THEN a.customer_name ELSE b.customer_name
        END AS customer_name,
      CASE WHEN b.customer_id IS NULL THEN a.state ELSE b.state END AS state,
      a.customer_id IS NULL AS was_insert, b.customer_id IS NOT NULL AS was_in_batch
    FROM first_feed a FULL JOIN second_feed b ON a.customer_id = b.customer_id"""

_SCD2 = """
    SELECT a.*, DATE '2024-01-01' AS valid_from,
      CASE WHEN b.state IS DISTINCT FROM a.state AND b.customer_id IS NOT NULL
        THEN DATE '2024-06-01' END AS valid_to,
      NOT (b.state IS DISTINCT FROM a.state AND b.customer_id IS NOT NULL) AS is_current
    FROM first_feed a LEFT JOIN second_feed b ON a.customer_id = b.customer_id
    UNION ALL
    SELECT b.*, DATE '2024-06-01', CAST(NULL AS date), true
    FROM second_feed b LEFT JOIN first_feed a ON a.customer_id = b.customer_id
    WHERE a.customer_id IS NULL OR a.state IS DISTINCT FROM b.state"""

_ORACLE = {
    "scan_csv_typed": "SELECT * FROM raw_orders",
    "scan_json_typed": "SELECT * FROM raw_orders",
    "scan_parquet_typed": "SELECT * FROM raw_orders",
    "source_file_stats": """
        SELECT format, count(*) > 0 AS files_found, count(*) > 0 AS bytes_positive
        FROM raw_orders, (VALUES ('csv'), ('json'), ('parquet')) AS f(format) GROUP BY format""",
    "scan_row_count": _counts("table", _RAW).replace("AS table", 'AS "table"'),
    "bronze_round_trip": " UNION ALL ".join(
        f"SELECT '{name}' AS \"table\", count(*) AS expected, count(*) AS actual FROM {view}"
        for name, view in _RAW.items()
    ),
    "range_bucket": """
        SELECT CAST(trunc(order_id / 1000) AS int) AS bucket, count(*) AS n
        FROM raw_order_items GROUP BY ALL""",
    "filter_not_null": """
        SELECT * FROM raw_orders WHERE seller_id IS NOT NULL AND customer_id IS NOT NULL""",
    "dedup_by_key": "SELECT * FROM kept_customers",
    "dedup_whole_rows": """
        SELECT order_id, product_id, count(*) AS n_copies FROM raw_order_items GROUP BY ALL""",
    "mask_card": """
        SELECT r.customer_id, card AS masked
        FROM raw_customers r JOIN masks m ON r.customer_id = m.customer_id""",
    "mask_account": """
        SELECT r.customer_id, account AS masked
        FROM raw_customers r JOIN masks m ON r.customer_id = m.customer_id""",
    "mask_account_in_documents": """
        SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10)), lambda line:
          CASE WHEN strpos(line, '@') = 0 OR length(line) - strpos(reverse(line), '@') <= 3
            THEN line
            ELSE left(line, 3)
              || repeat('*', length(line) - strpos(reverse(line), '@') - 3)
              || substr(line, length(line) - strpos(reverse(line), '@') + 1) END
          ), chr(10)) AS masked
        FROM documents""",
    "clean_order_items": "SELECT * FROM clean_order_items",
    "clean_customers": "SELECT * FROM clean_customers",
    "clean_sellers": "SELECT * FROM clean_sellers",
    "clean_orders_legacy": "SELECT * FROM clean_orders_legacy",
    "clean_orders_new": "SELECT * FROM clean_orders_new",
    "cast_rejects": """
        SELECT 'dob' AS "column",
          count(*) FILTER (dob IS NOT NULL AND TRY_CAST(dob AS date) IS NULL) AS rejects
        FROM raw_customers
        UNION ALL
        SELECT 'seller_rating', count(*) FILTER (
          seller_rating IS NOT NULL AND TRY_CAST(seller_rating AS double) IS NULL)
        FROM raw_sellers
        UNION ALL
        SELECT 'seller_active_date', count(*) FILTER (
          seller_active_date IS NOT NULL AND TRY_CAST(seller_active_date AS date) IS NULL)
        FROM raw_sellers""",
    "unify_orders": "SELECT * FROM unified",
    "union_by_name": """
        SELECT * FROM raw_orders
        UNION ALL BY NAME
        SELECT CAST(order_id AS varchar) AS order_id, customer_id, seller_id, payment_method
        FROM raw_orders_new
        UNION ALL BY NAME
        SELECT CAST(order_id AS varchar) AS order_id FROM raw_orders_new""",
    "merge_sources": """
        SELECT DISTINCT order_id, customer_id, seller_id, order_date, order_total_price,
          'merged' AS data_source
        FROM (SELECT * FROM raw_orders UNION ALL BY NAME
          SELECT * REPLACE (CAST(order_id AS varchar) AS order_id,
            CAST(order_date AS timestamp) AS order_date) FROM raw_orders_new)""",
    "merge_transform": "SELECT * REPLACE ('merged' AS data_source) FROM unified",
    "schema_in_use": "SELECT * FROM first_feed",
    "source_distribution": "SELECT source_system, count(*) AS n FROM unified GROUP BY ALL",
    "dim_customers": "SELECT * FROM dim_customers",
    "dim_sellers": """
        SELECT seller_id AS seller_key, seller_id, seller_company_name AS company_name,
          seller_business_type AS business_type, seller_rating AS rating,
          seller_active_date AS active_date,
          CAST(date_diff('day', seller_active_date, DATE '2025-01-01') AS int) AS days_active,
          seller_address AS address, seller_state AS state, seller_country AS country,
          seller_zipcode AS zipcode, data_source
        FROM clean_sellers""",
    "dim_date": "SELECT * FROM dim_date",
    "fact_orders": "SELECT * FROM fact_orders",
    "fact_sales_summary": "SELECT * FROM fact_sales_summary",
    "star_sources": _counts(
        "source",
        {"customers": "clean_customers", "sellers": "clean_sellers", "orders": "unified"},
    ),
    "report_customer_ltv": _ltv("true"),
    "report_customer_ltv_by_country": _ltv("country = 'NATION_7'"),
    "report_sales_trend": """
        SELECT year, month, month_name, count(order_key) AS order_count,
          CAST(sum(CAST(order_amount AS decimal(18,2))) AS double) AS revenue
        FROM fact_orders JOIN dim_date ON order_date_key = date_key
        WHERE source_system = 'legacy' GROUP BY ALL""",
    "lake_row_counts": _counts(
        "table",
        {
            **{f"bronze.{name}": view for name, view in _RAW.items()},
            "silver.order_items": "clean_order_items",
            "silver.customers": "clean_customers",
            "silver.sellers": "clean_sellers",
            "silver.orders": "unified",
            "gold.dim_customers": "clean_customers",
            "gold.dim_sellers": "clean_sellers",
            "gold.fact_orders": "unified",
            "gold.fact_sales_summary": "fact_sales_summary",
        },
    ).replace("AS table", 'AS "table"'),
    "dq_nulls": _nulls(),
    "dq_duplicates": """
        SELECT CAST(sum(n) AS bigint) AS total_rows, count(*) AS unique_rows,
          CAST(sum(n) AS bigint) - count(*) AS duplicate_rows,
          (CAST(sum(n) AS bigint) - count(*)) * 100e0 / CAST(sum(n) AS bigint) AS duplicate_pct
        FROM (SELECT count(*) AS n FROM raw_order_items GROUP BY order_id, product_id)""",
    "dq_value_ranges": _ranges("c_acctbal", "customer")
    + " UNION ALL "
    + _ranges("s_acctbal", "supplier"),
    "dq_partition_sizes": f"""
        SELECT CAST(CAST(o_orderdate AS date) AS varchar) AS partition, count(*) AS row_count
        FROM orders GROUP BY ALL ORDER BY row_count DESC, partition LIMIT 20""",
    "dq_skew_stats": """
        SELECT count(*) AS partitions, max(row_count) AS max, min(row_count) AS min,
          avg(row_count) AS mean, CAST(median(row_count) AS double) AS median,
          max(row_count) / median(row_count) AS skew_factor FROM uneven""",
    "dq_partition_skew": f"""
        SELECT partition, row_count,
          row_count / (SELECT median(row_count) FROM uneven) AS factor FROM uneven
        WHERE row_count > 2.0 * (SELECT median(row_count) FROM uneven)""",
    "quality_report": _report(),
    "key_hash_sample": "SELECT * EXCLUDE (slot) FROM new_slots WHERE slot < 262144",
    "dq_sample_estimate": """
        SELECT metric, CAST(exact AS double) AS exact, sampled / 0.25e0 AS estimate,
          abs(sampled / 0.25e0 - exact) <= exact * 0.25 AS within_tolerance FROM estimates""",
    "sink_replace_partitioned": """
        SELECT CAST(year(order_date) AS int) AS order_year, count(*) AS n
        FROM raw_orders GROUP BY ALL""",
    "sink_append": "SELECT source_system, count(*) AS n FROM unified GROUP BY ALL",
    "sink_merge_upsert": _MERGED_FEEDS,
    "sink_replace_managed": _MERGED_FEEDS,
    "write_reconciliation": " UNION ALL ".join(
        f"SELECT '{name}' AS \"table\", count(*) AS expected, count(*) AS actual, true AS ok"
        f" FROM {view}"
        for name, view in _RAW.items()
    ),
    "clustered_layout": """
        SELECT order_date_key, count(*) AS n FROM fact_orders GROUP BY ALL""",
    "table_details": """
        SELECT * FROM (VALUES ('order_id', 'string'), ('customer_id', 'bigint'),
          ('seller_id', 'bigint'), ('order_date', 'timestamp'), ('order_total_price', 'double'),
          ('payment_method', 'string'), ('order_year', 'int'), ('order_month', 'int')
        ) AS columns("column", type)""",
    "table_file_metrics": " UNION ALL ".join(
        f"SELECT '{name}' AS \"table\", count(*) > 0 AS has_files, count(*) > 0 AS has_bytes"
        f" FROM {view}"
        for name, view in _RAW.items()
    ),
    "layer_comparison": """
        SELECT count(*) > 0 AS all_sources_counted, count(*) > 0 AS result_counted,
          count(*) > 0 AS reduction_fits FROM unified""",
    "scd1_apply": _SCD1,
    "scd2_stamp": """
        SELECT *, DATE '2024-01-01' AS valid_from, CAST(NULL AS date) AS valid_to,
          true AS is_current FROM first_feed""",
    "scd2_apply": _SCD2,
    "bronze_rejects": """
        SELECT *, CAST(sum(n) OVER (PARTITION BY status) AS bigint) AS counted FROM (
          SELECT CASE WHEN order_id % 50 = 0 OR order_id % 60 = 0 THEN 'rejected' ELSE 'kept'
            END AS status, payment_method, count(*) AS n
          FROM raw_orders_new GROUP BY ALL)""",
    "dq_row_estimate": """
        SELECT metric, exact, true AS within_bounds, true AS estimate_within_bounds FROM (
          SELECT 'rows' AS metric, count(*) AS exact FROM raw_orders_new
          UNION ALL SELECT 'nulls:seller_id', count(*) - count(seller_id) FROM raw_orders_new
          UNION ALL SELECT 'nulls:order_date', count(*) - count(order_date) FROM raw_orders_new
          UNION ALL SELECT 'distinct:order_id', count(DISTINCT order_id) FROM raw_orders_new)""",
    "dq_exact_ranges": " UNION ALL ".join(
        f"""
        SELECT '{name}' AS "column", count(x) AS n, CAST(min(x) AS varchar) AS min,
          CAST(max(x) AS varchar) AS max, CAST(sum(x) AS varchar) AS total,
          count(*) FILTER (x < 0) AS negatives
        FROM (SELECT {value} AS x FROM lineitem)"""
        for name, value in {
            "big_key": "l_orderkey + 9007199254740993",
            "below_zero": "-l_partkey",
            "quantity": "CAST(l_quantity AS decimal(12,2))",
        }.items()
    ),
    "gold_merge_scd1": _SCD1,
    "gold_merge_scd2": _SCD2,
    "scd1_null_key": f"""
        SELECT nullif(customer_id, '7') AS customer_id, customer_name, state, was_insert
        FROM ({_SCD1})""",
    "scd2_null_key": f"""
        SELECT nullif(customer_id, '7') AS customer_id, * EXCLUDE (customer_id) FROM ({_SCD2})""",
    "scd2_late_changes": """
        SELECT customer_id, payment_method, valid_from,
          lead(valid_from) OVER w AS valid_to, lead(valid_from) OVER w IS NULL AS is_current
        FROM (
          SELECT * FROM (
            SELECT o_custkey AS customer_id, CAST(o_orderdate AS date) AS valid_from,
              max(o_orderpriority) AS payment_method
            FROM orders GROUP BY ALL)
          QUALIFY lag(payment_method) OVER (PARTITION BY customer_id ORDER BY valid_from)
            IS DISTINCT FROM payment_method)
        WINDOW w AS (PARTITION BY customer_id ORDER BY valid_from)""",
}


def oracle_sql() -> dict[str, str]:
    """Every query has one. Of what is about this engine's files, it says what must hold."""
    return {name: _sql(body) for name, body in _ORACLE.items()}
