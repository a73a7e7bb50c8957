"""ANSI SQL equivalents of the registered queries, over the given tables as views."""

from __future__ import annotations

from assay.plans.feeds import (
    CANCELLED_FROM,
    CLASSIFIED_UP_TO,
    CURRENCIES,
    FIRST_SALE_DAY,
    OFFSETS,
    SALE_DAYS,
)

ORACLE: dict[str, str] = {}

_CURRENCY_LIST = "[" + ", ".join(f"'{c}'" for c in CURRENCIES) + "]"
_OFFSET_LABELS = "[" + ", ".join(f"'{label}'" for label, _ in OFFSETS) + "]"
_OFFSET_MINUTES = "[" + ", ".join(str(m) for _, m in OFFSETS) + "]"

# Named subqueries; each lists the ones it reads.
_PARTS: dict[str, tuple[tuple[str, ...], str]] = {
    "country_names": (
        (),
        "SELECT printf('N%02d', n_nationkey) AS country, n_name AS country_name FROM nation",
    ),
    "typed_customers": (
        (),
        """SELECT c_custkey AS customer_id, c_name AS name, c_nationkey AS nation_key,
                  c_mktsegment AS segment,
                  CASE WHEN c_acctbal < 0 THEN NULL
                       WHEN c_mktsegment = 'BUILDING' THEN 'Customer' || c_custkey || '@Example.com'
                       ELSE 'customer' || c_custkey || '@example.com' END AS email,
                  CASE c_mktsegment WHEN 'BUILDING' THEN lower(n_name)
                       WHEN 'MACHINERY' THEN '  ' || n_name || ' '
                       WHEN 'FURNITURE' THEN 'The ' || n_name
                       ELSE n_name END AS typed_country
           FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    ),
    "customers": (
        ("country_names", "typed_customers"),
        """SELECT t.*, country FROM typed_customers t
           LEFT JOIN country_names ON upper(trim(typed_country)) = upper(trim(country_name))""",
    ),
    "accounts": (
        (),
        """SELECT DISTINCT 'U' || user_id AS account_id, 'customer' || user_id || '@example.com' AS email,
                  CAST(NULL AS VARCHAR) AS country FROM events
           UNION ALL
           SELECT 'S' || s_suppkey,
                  CASE WHEN s_acctbal >= 0 THEN 'supplier' || s_suppkey || '@example.com' END,
                  printf('N%02d', s_nationkey) FROM supplier""",
    ),
    "parties": (
        ("typed_customers", "accounts"),
        """SELECT coalesce(lower(trim(p.email)), lower(trim(w.email))) AS email,
                  p.customer_id AS pos_id, w.account_id AS web_id,
                  CAST(CASE WHEN p.customer_id IS NULL THEN 0 ELSE 1 END AS BIGINT) AS pos_accounts,
                  CAST(CASE WHEN w.account_id IS NULL THEN 0 ELSE 1 END AS BIGINT) AS web_accounts,
                  coalesce(lower(trim(p.email)), lower(trim(w.email)), 'POS:' || p.customer_id,
                           'WEB:' || w.account_id) AS party_key,
                  p.customer_id IS NOT NULL AS in_pos, w.account_id IS NOT NULL AS in_web
           FROM typed_customers p FULL OUTER JOIN accounts w ON lower(trim(p.email)) = lower(trim(w.email))""",
    ),
    "dim_party": (
        ("parties", "customers", "accounts"),
        """SELECT party_key, p.email, in_pos, in_web, coalesce(c.segment, 'Unallocated') AS customer_segment,
                  coalesce(c.country, a.country) AS country
           FROM parties p LEFT JOIN customers c ON p.pos_id = c.customer_id
           LEFT JOIN accounts a ON p.web_id = a.account_id""",
    ),
    "dim_country": (
        ("dim_party", "country_names"),
        """SELECT d.country, country_name FROM (SELECT DISTINCT country FROM dim_party WHERE country IS NOT NULL) d
           LEFT JOIN country_names n ON d.country = n.country""",
    ),
    "fx_rates": (
        (),
        """SELECT event_type AS currency, CAST(ts AS DATE) AS rate_date,
                  CAST(max(value) AS DECIMAL(18,8)) AS rate
           FROM events WHERE dayofweek(ts) NOT IN (0, 6) GROUP BY 1, 2""",
    ),
    "fx_daily": (
        ("fx_rates",),
        """SELECT currency, rate_date,
                  last_value(rate IGNORE NULLS) OVER w AS rate,
                  last_value(published IGNORE NULLS) OVER w AS published_on,
                  published IS NULL AS is_carried
           FROM (SELECT s.currency, d.rate_date, f.rate, f.rate_date AS published
                 FROM (SELECT currency, min(rate_date) AS first_day FROM fx_rates GROUP BY 1) s
                 JOIN (SELECT CAST(unnest(generate_series(min(rate_date), max(rate_date), INTERVAL 1 DAY)) AS DATE)
                              AS rate_date FROM fx_rates) d ON d.rate_date >= s.first_day
                 LEFT JOIN fx_rates f ON f.currency = s.currency AND f.rate_date = d.rate_date)
           WINDOW w AS (PARTITION BY currency ORDER BY rate_date)""",
    ),
    "hierarchy": (
        (),
        f"""SELECT p_partkey AS product_id, trim(p_brand) AS product_segment, trim(p_type) AS department
            FROM part WHERE p_size <= {CLASSIFIED_UP_TO}""",
    ),
    "latest_lines": (
        (),
        """SELECT * EXCLUDE (rn) FROM (
             SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
               ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount,
                        l_tax, l_returnflag, l_linestatus) AS rn
             FROM lineitem) WHERE rn = 1""",
    ),
    "pos_orders": (
        ("latest_lines", "typed_customers"),
        f"""SELECT l_orderkey AS order_id, l_linenumber AS line_no, o_custkey AS customer_id,
                   coalesce(lower(trim(email)), 'POS:' || o_custkey) AS party_key,
                   l_partkey AS product_id,
                   CAST(DATE '{FIRST_SALE_DAY}' + CAST(datediff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) % {SALE_DAYS} AS INTEGER) AS DATE) AS order_date,
                   {_CURRENCY_LIST}[nation_key % {len(CURRENCIES)} + 1] AS currency,
                   CAST(l_quantity AS BIGINT) AS quantity, CAST(l_extendedprice AS DECIMAL(19,4)) AS amount,
                   o_orderstatus = 'P' AS is_cancelled
            FROM latest_lines JOIN orders ON l_orderkey = o_orderkey
            JOIN typed_customers ON o_custkey = customer_id
            WHERE l_quantity >= 5 AND l_discount <= 0.08""",
    ),
    "fct_orders": (
        ("pos_orders", "fx_daily"),
        """SELECT order_id, line_no, customer_id, party_key, product_id, order_date, o.currency, quantity, amount,
                  CAST(amount * rate AS DECIMAL(19,4)) AS amount_usd, is_cancelled, f.is_carried AS rate_is_carried
           FROM pos_orders o LEFT JOIN fx_daily f ON o.currency = f.currency AND o.order_date = f.rate_date""",
    ),
    "web_events": (
        (),
        """SELECT *, CAST(props->>'$.k' AS INTEGER) AS k FROM events WHERE event_type = 'purchase'""",
    ),
    "web_orders": (
        ("web_events",),
        f"""SELECT CAST(event_id AS VARCHAR) AS web_order_id, 'customer' || user_id || '@example.com' AS email,
                   strftime(ts + to_minutes({_OFFSET_MINUTES}[k % {len(OFFSETS)} + 1]), '%Y-%m-%dT%H:%M:%S')
                     || {_OFFSET_LABELS}[k % {len(OFFSETS)} + 1] AS placed_at,
                   CASE WHEN k >= {CANCELLED_FROM} THEN 'cancelled' ELSE 'paid' END AS status,
                   {_CURRENCY_LIST}[k % {len(CURRENCIES)} + 1] AS currency, k, ts, user_id, event_id, value
            FROM web_events""",
    ),
    "web_lines_text": (
        ("web_orders",),
        """SELECT w.*, n FROM web_orders w, unnest(generate_series(1, 1 + k % 3)) AS t(n) WHERE k > 0""",
    ),
    "web_lines": (
        ("web_lines_text",),
        """SELECT event_id AS order_id, CAST(n AS INTEGER) AS line_no, 'U' || user_id AS account_id,
                  CAST(user_id + n - 1 AS BIGINT) AS product_id, CAST(date_trunc('second', ts) AS DATE) AS order_date,
                  currency, CAST(1 + (k + n) % 4 AS BIGINT) AS quantity,
                  CAST(CAST(value AS DECIMAL(19,4)) * (1 + (k + n) % 4) AS DECIMAL(19,4)) AS amount,
                  status = 'cancelled' AS is_cancelled
           FROM web_lines_text""",
    ),
    "fct_sales": (
        ("fct_orders", "web_lines", "fx_daily", "accounts"),
        """SELECT 'POS' AS channel_system, order_id, line_no, order_date, party_key, product_id, currency,
                  quantity, amount, amount_usd, is_cancelled, rate_is_carried
           FROM fct_orders
           UNION ALL
           SELECT 'WEB', order_id, line_no, order_date,
                  coalesce(lower(trim(a.email)), 'WEB:' || a.account_id), product_id, l.currency,
                  quantity, amount, CAST(amount * rate AS DECIMAL(19,4)), is_cancelled, f.is_carried
           FROM web_lines l LEFT JOIN fx_daily f ON l.currency = f.currency AND l.order_date = f.rate_date
           LEFT JOIN accounts a ON l.account_id = a.account_id""",
    ),
    "dim_product": (
        ("hierarchy", "fct_sales"),
        """SELECT product_id, product_segment, department FROM hierarchy
           UNION ALL
           SELECT DISTINCT product_id, 'Unallocated', 'Unallocated' FROM fct_sales
           WHERE product_id NOT IN (SELECT product_id FROM hierarchy)""",
    ),
    "dim_date": (
        ("fct_sales",),
        """SELECT order_date, CAST(year(order_date) AS INTEGER) AS calendar_year,
                  CAST(year(order_date) + (month(order_date) >= 4)::INTEGER AS INTEGER) AS fiscal_year,
                  CAST((month(order_date) + 8) % 12 // 3 + 1 AS INTEGER) AS fiscal_quarter,
                  printf('FY%02d', (year(order_date) + (month(order_date) >= 4)::INTEGER) % 100) AS fiscal_year_label,
                  printf('FY%02d Q%d', (year(order_date) + (month(order_date) >= 4)::INTEGER) % 100,
                         (month(order_date) + 8) % 12 // 3 + 1) AS fiscal_quarter_label
           FROM (SELECT DISTINCT order_date FROM fct_sales WHERE order_date IS NOT NULL)""",
    ),
    "summary": (
        ("fct_sales", "dim_date", "dim_product", "dim_party"),
        """SELECT fiscal_year_label, fiscal_quarter_label, department, product_segment, customer_segment, country,
                  channel_system, count(*) AS sale_lines, CAST(sum(quantity) AS BIGINT) AS units,
                  CAST(coalesce(sum(amount_usd) FILTER (NOT is_cancelled), 0) AS DECIMAL(29,4)) AS revenue_usd,
                  CAST(coalesce(sum(amount_usd) FILTER (is_cancelled), 0) AS DECIMAL(29,4)) AS cancelled_revenue_usd,
                  CAST(coalesce(sum(amount_usd) FILTER (NOT is_cancelled AND rate_is_carried), 0) AS DECIMAL(29,4))
                    AS revenue_at_carried_rate
           FROM fct_sales s LEFT JOIN dim_date d ON s.order_date = d.order_date
           LEFT JOIN dim_product p ON s.product_id = p.product_id
           LEFT JOIN dim_party y ON s.party_key = y.party_key
           GROUP BY ALL""",
    ),
    "sold": (
        (),
        """SELECT CAST(o_orderdate AS DATE) AS order_date, o_orderstatus = 'P' AS is_cancelled,
                  c_custkey AS customer_id, n_name AS country, r_name AS region,
                  CAST(l_quantity AS BIGINT) AS quantity, CAST(l_extendedprice AS DECIMAL(19,4)) AS amount,
                  o_orderkey AS order_id
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
           JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    ),
    "changes": (
        (),
        """SELECT CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS op,
                  event_id AS capture_offset, user_id AS erp_customer_id, event_type AS account_status,
                  'band ' || (CAST(props->>'$.k' AS INTEGER) % 5) AS credit_band,
                  CAST(CAST(ts AS DATE) - CAST(CAST(props->>'$.k' AS INTEGER) % 7 AS INTEGER) AS DATE) AS effective_date
           FROM events""",
    ),
    "months": (
        ("sold",),
        """SELECT strftime(order_date, '%Y-%m') AS month, CAST(sum(amount) AS DECIMAL(29,4)) AS revenue,
                  CAST(sum(quantity) AS DECIMAL(29,4)) AS units
           FROM sold GROUP BY 1""",
    ),
    "edges": (
        (),
        """SELECT DISTINCT source, target FROM (
             SELECT 'part ' || l_partkey AS source, 'order ' || l_orderkey AS target FROM lineitem
             UNION ALL SELECT 'supplier ' || l_suppkey, 'order ' || l_orderkey FROM lineitem
             UNION ALL SELECT 'nation ' || s_nationkey, 'supplier ' || s_suppkey FROM supplier
             UNION ALL SELECT 'region ' || n_regionkey, 'nation ' || n_nationkey FROM nation)""",
    ),
    "customer_text": (
        (),
        """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
                  CAST(CAST(c_acctbal AS DECIMAL(19,4)) AS VARCHAR) AS c_acctbal, c_mktsegment FROM customer""",
    ),
    "exploded": (
        ("web_orders",),
        """SELECT web_order_id, email, placed_at, status, currency,
                  CASE WHEN k > 0 THEN CAST(n - 1 AS INTEGER) END AS line_position,
                  CASE WHEN k > 0 THEN CAST(n AS VARCHAR) END AS line_no,
                  CASE WHEN k > 0 THEN CAST(user_id + n - 1 AS VARCHAR) END AS product_id,
                  CASE WHEN k > 0 THEN CAST(1 + (k + n) % 4 AS VARCHAR) END AS quantity,
                  CASE WHEN k > 0 THEN CAST(CAST(value AS DECIMAL(19,4)) AS VARCHAR) END AS unit_price
           FROM web_orders, unnest(generate_series(1, CASE WHEN k > 0 THEN 1 + k % 3 ELSE 1 END)) AS t(n)""",
    ),
}


def _sql(body: str, *reads: str, instead: dict[str, str] | None = None) -> str:
    """``body`` behind a WITH clause holding everything it reads, in dependency order.

    ``instead`` gives subqueries another body, over the one they have, named ``given``.
    """
    order: list[str] = []

    def add(name: str) -> None:
        for needed in _PARTS[name][0]:
            add(needed)
        if name not in order:
            order.append(name)

    for name in reads:
        add(name)
    if not order:
        return body
    recursive = "RECURSIVE " if body.startswith("RECURSIVE ") else ""
    bodies = {name: _PARTS[name][1] for name in order}
    for name, other in (instead or {}).items():
        bodies[name] = f"WITH given AS ({bodies[name]}) {other}"
    parts = ", ".join(f"{name} AS ({bodies[name]})" for name in order)
    if recursive:
        return f"WITH RECURSIVE {parts}, {body.removeprefix('RECURSIVE ')}"
    return f"WITH {parts} {body}"


def _ratio(part: str, whole: str, name: str) -> str:
    """``part / whole`` at nine places, half up, in exact integers (both have four places)."""
    a, b = f"CAST(({part}) * 10000 AS HUGEINT)", f"CAST(({whole}) * 10000 AS HUGEINT)"
    scaled = f"({a} * 2000000000 + {b}) // (2 * {b})"
    return f"CAST(CAST({scaled} AS DECIMAL(28,0)) * CAST(0.000000001 AS DECIMAL(10,9)) AS DECIMAL(38,9)) AS {name}"


def _add(name: str, body: str, *reads: str) -> None:
    ORACLE[name] = _sql(body, *reads)


# --- revenue
_add(
    "fiscal_revenue",
    """SELECT printf('FY%02d Q%d', (year(order_date) + (month(order_date) >= 4)::INTEGER) % 100,
                     (month(order_date) + 8) % 12 // 3 + 1) AS fiscal_quarter, region,
              CAST(sum(amount) FILTER (NOT is_cancelled) AS DECIMAL(29,4)) AS revenue,
              CAST(sum(amount) FILTER (is_cancelled) AS DECIMAL(29,4)) AS cancelled_revenue,
              count(*) AS sale_lines
       FROM sold GROUP BY 1, 2""",
    "sold",
)
_add(
    "daily_revenue",
    """SELECT order_date, country, count(DISTINCT order_id) AS orders, CAST(sum(quantity) AS BIGINT) AS units,
              CAST(sum(amount) AS DECIMAL(29,4)) AS revenue FROM sold GROUP BY 1, 2""",
    "sold",
)

# --- dedupe, quarantine, conform
_add("latest_line", "SELECT * FROM latest_lines", "latest_lines")
_add(
    "redelivery_check",
    """SELECT CAST(sum(n) AS BIGINT) AS rows, count(*) AS distinct_keys, CAST(sum(n - 1) AS BIGINT) AS redelivered,
              max(n) AS most_deliveries
       FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
)
_add(
    "quarantine_lines",
    """SELECT l_orderkey, l_linenumber, l_quantity, l_discount,
              concat_ws('; ', CASE WHEN l_quantity < 5 THEN 'small quantity' END,
                              CASE WHEN l_discount > 0.08 THEN 'discount too high' END) AS reasons
       FROM latest_lines WHERE l_quantity < 5 OR l_discount > 0.08""",
    "latest_lines",
)
_add(
    "quarantine_accounting",
    """SELECT CASE WHEN l_quantity < 5 OR l_discount > 0.08 THEN 'quarantined' ELSE 'clean' END AS part,
              count(*) AS rows FROM latest_lines GROUP BY 1""",
    "latest_lines",
)
_add(
    "money_conform",
    """SELECT l_returnflag, count(*) FILTER (l_returnflag <> 'R') AS parsed,
              count(*) FILTER (l_returnflag = 'R') AS unparsed,
              CAST(sum(CAST(l_extendedprice AS DECIMAL(19,4))) FILTER (l_returnflag <> 'R') AS DECIMAL(29,4)) AS total
       FROM lineitem GROUP BY 1""",
)
_add("country_conform", "SELECT customer_id, typed_country, country FROM customers", "customers")
_add("hierarchy_conform", "SELECT * FROM hierarchy", "hierarchy")
_add(
    "domain_check",
    """SELECT coalesce(f.v, e.v) AS value, CASE WHEN f.v IS NULL THEN 'absent' ELSE 'unexpected' END AS problem
       FROM (SELECT DISTINCT l_returnflag AS v FROM lineitem) f
       FULL OUTER JOIN (VALUES ('A'), ('N'), ('X')) e(v) ON f.v = e.v WHERE f.v IS NULL OR e.v IS NULL""",
)
_add(
    "distincts",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_values FROM lineitem"
        for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate", "l_returnflag")
    ),
)

# --- identity
_add("party", "SELECT * FROM parties", "parties")
_add(
    "party_cohorts",
    """SELECT *, matched + pos_only + web_only = parties AS accounted, matched > naive_matches AS conforming_gains
       FROM (SELECT count(*) FILTER (in_pos AND in_web) AS matched, count(*) FILTER (in_pos AND NOT in_web) AS pos_only,
                    count(*) FILTER (in_web AND NOT in_pos) AS web_only, count(*) FILTER (email IS NULL) AS no_email,
                    count(*) AS parties,
                    (SELECT count(DISTINCT t.email) FROM typed_customers t JOIN accounts a ON t.email = a.email)
                      AS naive_matches
             FROM parties)""",
    "parties",
)
_add(
    "missing_key_apart",
    """SELECT customer_id, lower(c.email) AS email, account_id FROM typed_customers c
       LEFT JOIN accounts a ON lower(c.email) = lower(a.email)""",
    "typed_customers",
    "accounts",
)
_add(
    "key_overlap",
    """SELECT count(DISTINCT user_id) AS shared_keys FROM events
       WHERE user_id IN (SELECT c_custkey FROM customer)""",
)

# --- nested orders and offsets
_add("order_lines_exploded", "SELECT * FROM exploded", "exploded")
ORACLE["json_pages"] = ORACLE["order_lines_exploded"]
_add(
    "nested_survived",
    """SELECT count(*) AS orders, count(*) FILTER (k > 0) AS orders_with_lines,
              CAST(sum(CASE WHEN k > 0 THEN 1 + k % 3 ELSE 0 END) AS BIGINT) AS lines FROM web_orders""",
    "web_orders",
)
_add(
    "utc_order_date",
    """SELECT web_order_id, placed_at, CAST(ts AS DATE) AS utc_day, CAST(left(placed_at, 10) AS DATE) AS local_day
       FROM web_orders""",
    "web_orders",
)

# --- exchange rates
_add("fx_dense", "SELECT * FROM fx_daily", "fx_daily")
_add(
    "fx_accounting",
    """SELECT *, dense_rows = series * calendar_days AS is_dense FROM (
         SELECT count(*) AS dense_rows, count(*) FILTER (is_carried) AS carried_rows,
                count(*) FILTER (NOT is_carried) AS published_rows, count(DISTINCT currency) AS series,
                datediff('day', min(rate_date), max(rate_date)) + 1 AS calendar_days FROM fx_daily)""",
    "fx_daily",
)
_add(
    "fx_gap",
    """SELECT *, calendar_span - published_days AS gap_days FROM (
         SELECT datediff('day', min(rate_date), max(rate_date)) + 1 AS calendar_span,
                count(DISTINCT rate_date) AS published_days FROM fx_rates)""",
    "fx_rates",
)

# --- the star
_add("dim_customer", "SELECT customer_id, name, country FROM customers", "customers")
_add("dim_party", "SELECT * FROM dim_party", "dim_party")
_add("dim_country", "SELECT * FROM dim_country", "dim_country")
_add("fct_orders", "SELECT * FROM fct_orders", "fct_orders")
_add("fct_sales", "SELECT * FROM fct_sales", "fct_sales")
_add(
    "sales_usd",
    """SELECT channel_system, currency, count(*) AS sale_lines, CAST(sum(quantity) AS BIGINT) AS units,
              CAST(coalesce(sum(amount_usd) FILTER (NOT is_cancelled), 0) AS DECIMAL(29,4)) AS revenue_usd,
              CAST(coalesce(sum(amount_usd) FILTER (is_cancelled), 0) AS DECIMAL(29,4)) AS cancelled_revenue_usd,
              CAST(coalesce(sum(amount_usd) FILTER (NOT is_cancelled AND rate_is_carried), 0) AS DECIMAL(29,4))
                AS revenue_at_carried_rate
       FROM fct_sales GROUP BY 1, 2""",
    "fct_sales",
)
_add("dim_product", "SELECT * FROM dim_product", "dim_product")
_add("dim_date", "SELECT * FROM dim_date", "dim_date")
_add(
    "fct_daily_revenue",
    """SELECT order_date, country, count(DISTINCT order_id) AS orders, CAST(sum(quantity) AS BIGINT) AS units,
              CAST(sum(amount_usd) AS DECIMAL(29,4)) AS revenue
       FROM fct_orders o JOIN customers c ON o.customer_id = c.customer_id GROUP BY 1, 2""",
    "fct_orders",
    "customers",
)
_add("fct_revenue_summary", "SELECT * FROM summary", "summary")

_add(
    "medallion_tables",
    " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, count(*) AS rows FROM {part}"
        for table, part in (
            ("silver_customers", "customers"),
            ("silver_orders", "pos_orders"),
            ("silver_quarantine_orders", "latest_lines WHERE l_quantity < 5 OR l_discount > 0.08"),
            ("silver_web_customers", "accounts"),
            ("silver_web_order_lines", "web_lines"),
            ("silver_party", "parties"),
            ("silver_fx_daily", "fx_daily"),
            ("silver_product_hierarchy", "hierarchy"),
            ("dim_customer", "customers"),
            ("dim_party", "dim_party"),
            ("dim_country", "dim_country"),
            ("fct_orders", "fct_orders"),
            ("fct_sales", "fct_sales"),
            ("dim_product", "dim_product"),
            ("dim_date", "dim_date"),
            ("fct_daily_revenue", "(SELECT DISTINCT o.order_date, c.country FROM fct_orders o JOIN customers c ON o.customer_id = c.customer_id)"),
            ("fct_revenue_summary", "summary"),
        )
    ),
    "summary",
    "dim_country",
)

# --- measures
_SALES_MEASURES = f"""CAST(sum(amount) AS DECIMAL(29,4)) AS total_revenue,
              CAST(sum(quantity) AS BIGINT) AS total_units,
              {_ratio("sum(amount)", "sum(quantity)", "revenue_per_unit")}, count(*) AS sale_lines"""
_add(
    "measures_by_segment",
    f"""SELECT c.segment AS customer_segment, c.country AS customer_country, {_SALES_MEASURES}
        FROM sold s JOIN customers c ON s.customer_id = c.customer_id GROUP BY 1, 2""",
    "sold",
    "customers",
)
_add("measures_by_day", f"SELECT order_date, {_SALES_MEASURES} FROM sold GROUP BY 1", "sold")
_add(
    "model_duplicate_keys",
    """SELECT 'account' AS table_name, CAST(user_id AS VARCHAR) AS key, count(*) AS occurrences
       FROM events GROUP BY 2 HAVING count(*) > 1""",
)
_add(
    "pack_by_quarter",
    f"""SELECT fiscal_quarter_label, channel_system, CAST(sum(revenue_usd) AS DECIMAL(29,4)) AS revenue_usd,
              CAST(sum(units) AS BIGINT) AS units_sold,
              CAST(sum(cancelled_revenue_usd) AS DECIMAL(29,4)) AS cancelled_revenue,
              CAST(sum(revenue_usd) + sum(cancelled_revenue_usd) AS DECIMAL(29,4)) AS gross_revenue,
              CAST(sum(revenue_at_carried_rate) AS DECIMAL(29,4)) AS revenue_at_carried_rate,
              {_ratio("sum(revenue_at_carried_rate)", "sum(revenue_usd)", "carried_rate_share")}
       FROM summary GROUP BY 1, 2""",
    "summary",
)
_add(
    "pack_in_model_names",
    """SELECT order_date AS "OrderDate", calendar_year AS "CalendarYear", fiscal_year AS "FiscalYear",
              fiscal_quarter AS "FiscalQuarter", fiscal_year_label AS "FiscalYearLabel",
              fiscal_quarter_label AS "FiscalQuarterLabel" FROM dim_date""",
    "dim_date",
)

# --- the change stream
_add("cdc_envelope", "SELECT * FROM changes", "changes")
_add(
    "cdc_faults",
    """SELECT CASE event_type WHEN 'view' THEN 'snapshot read' WHEN 'click' THEN 'unknown operation'
                   WHEN 'purchase' THEN 'no row image' ELSE 'tombstone' END AS fault, count(*) AS events
       FROM events WHERE event_type <> 'error' GROUP BY 1""",
)
_add("change_counts", "SELECT op, count(*) AS events FROM changes GROUP BY 1", "changes")
ORACLE["redelivered_changes"] = ORACLE["change_counts"]
_add(
    "current_state",
    """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY erp_customer_id
         ORDER BY capture_offset DESC) AS rn FROM changes) WHERE rn = 1 AND op <> 'D'""",
    "changes",
)
ORACLE["stream_changes"] = ORACLE["current_state"]
_add(
    "scd2",
    """SELECT * EXCLUDE (effective_date), effective_date AS valid_from
       FROM (SELECT *, lead(effective_date) OVER (PARTITION BY erp_customer_id
               ORDER BY effective_date, capture_offset) AS valid_to,
               capture_offset = max(capture_offset) OVER (PARTITION BY erp_customer_id) AS is_current
             FROM changes) WHERE op <> 'D'""",
    "changes",
)
_add(
    "scd2_current_is_live",
    """SELECT erp_customer_id, capture_offset FROM changes
       WHERE op <> 'D' AND (erp_customer_id, capture_offset) IN
         (SELECT (erp_customer_id, max(capture_offset)) FROM changes GROUP BY erp_customer_id)
       EXCEPT SELECT erp_customer_id, last FROM
         (SELECT erp_customer_id, max(capture_offset) AS last, arg_max(op, capture_offset) AS op
          FROM changes GROUP BY 1) WHERE op <> 'D'""",
    "changes",
)
_add(
    "order_disagreement",
    """SELECT erp_customer_id, count(*) AS steps_back
       FROM (SELECT erp_customer_id, effective_date, lead(effective_date) OVER (PARTITION BY erp_customer_id
               ORDER BY capture_offset) AS following FROM changes)
       WHERE following < effective_date GROUP BY 1""",
    "changes",
)

# --- contracts
_RULES = (
    ("orders", "o_orderkey_unique", "o_orderkey", "uniqueness", "duplicateValues",
     "SELECT count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)"),
    ("orders", "o_orderkey_not_null", "o_orderkey", "completeness", "nullValues",
     "SELECT count(*) FROM orders WHERE o_orderkey IS NULL"),
    ("orders", "o_orderstatus_not_null", "o_orderstatus", "completeness", "nullValues",
     "SELECT count(*) FROM orders WHERE o_orderstatus IS NULL"),
    ("orders", "o_orderstatus_accepted", "o_orderstatus", "conformity", "invalidValues",
     "SELECT count(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O')"),
    ("orders", "o_custkey_resolves_in_customer", "o_custkey", "consistency", "unresolvedKeys",
     "SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)"),
    ("lineitem", "l_orderkey_unique", "l_orderkey", "uniqueness", "duplicateValues",
     "SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1)"),
    ("lineitem", "l_orderkey_resolves_in_orders", "l_orderkey", "consistency", "unresolvedKeys",
     "SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)"),
    ("lineitem", "l_partkey_resolves_in_classified_part", "l_partkey", "consistency", "unresolvedKeys",
     "SELECT count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT product_id FROM hierarchy)"),
    ("lineitem", "l_suppkey_present", "l_suppkey", "completeness", "nullValues",
     "SELECT count(*) FROM lineitem WHERE l_suppkey IS NULL"),
    ("lineitem", "l_returnflag_accepted", "l_returnflag", "conformity", "invalidValues",
     "SELECT count(*) FROM lineitem WHERE l_returnflag NOT IN ('A', 'N')"),
    ("lineitem", "quantity_is_positive", "l_quantity", "validity", "invalidRows",
     "SELECT count(*) FROM lineitem WHERE NOT l_quantity > 0"),
    ("lineitem", "discount_below_tenth", "l_discount", "validity", "invalidRows",
     "SELECT count(*) FROM lineitem WHERE NOT l_discount < 0.1"),
    ("priced_customer", "customer_id_unique", "customer_id", "uniqueness", "duplicateValues",
     "SELECT count(*) FROM (SELECT 1 FROM customers GROUP BY customer_id HAVING count(*) > 1)"),
    ("priced_customer", "email_not_null", "email", "completeness", "nullValues",
     "SELECT count(*) FROM customers WHERE email IS NULL"),
    ("priced_customer", "country_not_null", "country", "completeness", "nullValues",
     "SELECT count(*) FROM customers WHERE country IS NULL"),
    ("customer", "c_name_not_null", "c_name", "completeness", "nullValues", "SELECT CAST(NULL AS BIGINT)"),
)
_add(
    "dq_report",
    "SELECT *, violations IS NOT NULL AS evaluated, coalesce(violations = 0, FALSE) AS passed FROM ("
    + " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{r}' AS rule, '{c}' AS column_name, '{d}' AS dimension, "
        f"'{m}' AS metric, ({q}) AS violations"
        for t, r, c, d, m, q in _RULES
    )
    + ")",
    "hierarchy",
    "customers",
)
_add(
    "dq_duplicate_values",
    "SELECT l_orderkey, count(*) AS occurrences FROM lineitem GROUP BY 1 HAVING count(*) > 1",
)
_add(
    "dq_invalid_values",
    "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus NOT IN ('F', 'O')",
)
_add("dq_null_values", "SELECT customer_id, segment FROM customers WHERE email IS NULL", "customers")
_add(
    "dq_unresolved_keys",
    """SELECT l_partkey AS key, count(*) AS rows FROM lineitem
       WHERE l_partkey NOT IN (SELECT product_id FROM hierarchy) GROUP BY 1""",
    "hierarchy",
)
_add(
    "dq_channels",
    """SELECT value FROM (VALUES ('POS'), ('WEB'), ('PHONE')) t(value)
       WHERE value NOT IN (SELECT channel_system FROM fct_sales)""",
    "fct_sales",
)
_add(
    "dq_countries",
    """SELECT country AS key, count(*) AS rows FROM dim_party
       WHERE country NOT IN (SELECT country FROM dim_country WHERE country < 'N12') GROUP BY 1""",
    "dim_country",
)
_add(
    "dq_fiscal_year",
    """SELECT month(d) < 4 AS same_as_calendar, month(d) < 4 AS may_be_same, count(*) AS dates
       FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders) GROUP BY 1, 2""",
)
_add(
    "dq_money",
    """SELECT count(*) FILTER (CAST(CAST(l_extendedprice AS DECIMAL(19,4)) * 10000 AS BIGINT)
                               % CAST(l_quantity AS BIGINT) <> 0) AS losing_digits,
              'l_extendedprice' AS float_columns FROM lineitem""",
)
_add(
    "dq_control_total",
    """SELECT (SELECT CAST(sum(amount_usd) FILTER (NOT is_cancelled) AS DECIMAL(29,4)) FROM fct_sales) AS whole_total,
              CAST(sum(revenue_usd) AS DECIMAL(29,4)) AS parts_total, CAST(0 AS DECIMAL(30,4)) AS lost FROM summary""",
    "summary",
)

# --- reconciliation
_add(
    "reconcile_agrees",
    """SELECT month, '' AS field, '' AS problem, revenue AS left_value, revenue AS right_value
       FROM months WHERE revenue <> revenue""",
    "months",
)
_add(
    "reconcile_differs",
    """SELECT month, '' AS field, 'left only' AS problem, CAST(NULL AS DECIMAL(29,4)) AS left_value,
              CAST(NULL AS DECIMAL(29,4)) AS right_value FROM months WHERE month LIKE '1997%'
       UNION ALL
       SELECT month, 'revenue', 'differs', revenue, CAST(revenue + 1 AS DECIMAL(29,4))
       FROM months WHERE month LIKE '1998%'""",
    "months",
)
_HEADLINE = """SELECT CAST(sum(amount_usd) FILTER (NOT is_cancelled) AS DECIMAL(29,4)) AS revenue_usd,
              CAST(sum(amount_usd) FILTER (is_cancelled) AS DECIMAL(29,4)) AS cancelled_revenue_usd,
              count(*) AS sale_lines FROM fct_sales"""
_add("headline_snapshot", _HEADLINE, "fct_sales")
_add(
    "snapshot_diff",
    f"""SELECT metric, 'value' AS field, 'differs' AS problem, CAST(a AS DECIMAL(29,4)) AS left_value,
               CAST(b AS DECIMAL(29,4)) AS right_value
        FROM (SELECT unnest(['revenue_usd', 'cancelled_revenue_usd', 'sale_lines']) AS metric,
                     unnest([l.revenue_usd, l.cancelled_revenue_usd, l.sale_lines]) AS a,
                     unnest([r.revenue_usd, r.cancelled_revenue_usd, r.sale_lines]) AS b
              FROM ({_HEADLINE}) l, ({_HEADLINE} WHERE channel_system = 'POS') r)
        WHERE abs(a - b) > 0.01""",
    "fct_sales",
)
_add(
    "pack_total",
    """SELECT CAST(sum(revenue_usd) AS DECIMAL(29,4)) AS pack_total,
              (SELECT CAST(sum(amount_usd) FILTER (NOT is_cancelled) AS DECIMAL(29,4)) FROM fct_sales) AS export_total,
              TRUE AS agrees FROM summary""",
    "summary",
)
_add(
    "published_snapshot",
    f"""SELECT CAST(revenue_usd AS VARCHAR) AS revenue_usd,
               CAST(cancelled_revenue_usd AS VARCHAR) AS cancelled_revenue_usd,
               CAST(sale_lines AS VARCHAR) AS sale_lines,
               'both_selling_systems,every_country_resolves,no_revenue_lost' AS contracts FROM ({_HEADLINE})""",
    "fct_sales",
)

# --- lineage and profile
_add("lineage_edges", "SELECT * FROM edges", "edges")
_add(
    "lineage_labelled",
    """SELECT 'customer ' || o_custkey AS source, 'order ' || o_orderkey AS target,
              coalesce('line ' || status, 'declared only') AS producer, status IS NOT NULL AS observed
       FROM orders LEFT JOIN (SELECT l_orderkey, min(l_linestatus) AS status FROM lineitem GROUP BY 1)
         ON o_orderkey = l_orderkey""",
)
_add(
    "lineage_orphans",
    """SELECT 'order ' || o_orderkey AS node, 'never read' AS problem FROM orders
       WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
       UNION ALL
       SELECT DISTINCT 'order ' || l_orderkey, 'never written' FROM lineitem
       WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)""",
)
_add(
    "upstream_sources",
    """RECURSIVE trace AS (
         SELECT 'order ' || o_orderkey AS node, 'order ' || o_orderkey AS ancestor, 0 AS distance FROM orders
         UNION
         SELECT node, source, distance + 1 FROM trace JOIN edges ON target = ancestor)
       SELECT node, ancestor AS origin, CAST(min(distance) AS INTEGER) AS distance FROM trace
       WHERE distance > 0 AND ancestor NOT IN (SELECT target FROM edges) GROUP BY 1, 2""",
    "edges",
)

# Columns of the given tables and their catalogue types.
_COLUMNS = {
    "region": {"r_regionkey": "INT", "r_name": "STRING"},
    "nation": {"n_nationkey": "INT", "n_name": "STRING", "n_regionkey": "INT"},
    "customer": {"c_custkey": "INT", "c_name": "STRING", "c_nationkey": "INT", "c_acctbal": "DOUBLE",
                 "c_mktsegment": "STRING"},
    "supplier": {"s_suppkey": "INT", "s_name": "STRING", "s_nationkey": "INT", "s_acctbal": "DOUBLE"},
    "part": {"p_partkey": "INT", "p_name": "STRING", "p_brand": "STRING", "p_type": "STRING", "p_size": "INT",
             "p_retailprice": "DOUBLE"},
    "orders": {"o_orderkey": "INT", "o_custkey": "INT", "o_orderstatus": "STRING", "o_totalprice": "DOUBLE",
               "o_orderdate": "TIMESTAMP", "o_orderpriority": "STRING"},
    "lineitem": {"l_orderkey": "INT", "l_partkey": "INT", "l_suppkey": "INT", "l_linenumber": "INT",
                 "l_quantity": "DOUBLE", "l_extendedprice": "DOUBLE", "l_discount": "DOUBLE", "l_tax": "DOUBLE",
                 "l_returnflag": "STRING", "l_linestatus": "STRING", "l_shipdate": "TIMESTAMP"},
    "events": {"event_id": "INT", "ts": "TIMESTAMP", "user_id": "INT", "event_type": "STRING", "value": "DOUBLE",
               "props": "STRING"},
    "documents": {"doc_id": "INT", "text": "STRING", "lang": "STRING", "source": "STRING", "n_chars": "INT"},
    "embeddings": {"vec_id": "INT", "embedding": "STRING", "label": "INT"},
    "pages": {"page_id": "INT", "url": "STRING", "html": "STRING"},
    "benchmark": {"item_id": "INT", "text": "STRING"},
    "labels": {"doc_id": "INT", "quality": "INT", "toxic": "INT"},
    "conversations": {"conv_id": "INT", "turn": "INT", "role": "STRING", "text": "STRING"},
}
_add(
    "column_profile",
    " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{kind}' AS data_type, count(*) AS rows, "
        f'count(*) - count("{column}") AS nulls FROM {table}'
        for table, columns in _COLUMNS.items()
        for column, kind in columns.items()
    ),
)

_add(
    "column_distincts",
    " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, "
        f'count(DISTINCT "{column}") AS distinct_values, TRUE AS sketch_is_near FROM {table}'
        for table in ("region", "nation", "customer", "supplier", "part", "orders")
        for column in _COLUMNS[table]
    ),
)

# --- landed files and tables
_add("csv_parts", "SELECT * FROM customer_text", "customer_text")
_add("csv_reordered", "SELECT * FROM customer_text", "customer_text")
_add(
    "missing_key_quarantined",
    """SELECT l_partkey, l_suppkey, l_linenumber, l_quantity, 'key missing' AS reasons
       FROM lineitem WHERE l_linenumber = 7""",
)
_add(
    "jsonl_parts",
    """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
              CAST(CAST(o_totalprice AS DECIMAL(19,4)) AS VARCHAR) AS o_totalprice,
              strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM orders""",
)
_add("null_columns", "SELECT 'e_mail' AS column_name UNION ALL SELECT 'lines.sku'")
_add(
    "leaf_counts",
    " UNION ALL ".join(
        [
            f"SELECT '{c}' AS column_name, count({c}) AS present FROM web_orders"
            for c in ("web_order_id", "email", "placed_at", "status", "currency")
        ]
        + [
            f"SELECT 'lines.{c}' AS column_name, count(*) AS present FROM web_lines_text"
            for c in ("line_no", "product_id", "quantity", "unit_price")
        ]
    ),
    "web_lines_text",
)
_add(
    "schema_drift",
    "SELECT 'c_acctbal' AS appeared, 'c_balance' AS missing, '' AS duplicated, FALSE AS trailing_delimiter",
)
_FAULTS = """CAST(0 AS BIGINT) AS size_faults, CAST(0 AS BIGINT) AS digest_faults,
              CAST({marker} AS BIGINT) AS marker_faults, CAST({page} AS BIGINT) AS page_faults,
              CAST(0 AS BIGINT) AS missing_parts"""
_add(
    "landing_integrity",
    f"""SELECT 'customers' AS feed, count(*) AS rows, {_FAULTS.format(marker="NULL", page="NULL")} FROM customer
        UNION ALL
        SELECT 'web orders', count(*), {_FAULTS.format(marker="NULL", page="0")} FROM events
        WHERE event_type = 'purchase'
        UNION ALL
        SELECT 'parts', count(*), {_FAULTS.format(marker="0", page="NULL")} FROM part""",
)
_add(
    "landing_faults",
    """SELECT * FROM (VALUES ('bytes received', 'length differs'), ('manifest', 'not in the manifest'),
         ('digest', 'digest differs'), ('published digest', 'no published digest'), ('marker', 'marker missing'),
         ('sequence', 'missing'), ('sequence', 'past the end'), ('page', 'incomplete page')) t("check", problem)""",
)
_add(
    "landed_tables",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS rows, CAST({len(_COLUMNS[t])} AS BIGINT) AS columns, "
        f"'{','.join(_COLUMNS[t])}' AS column_names FROM {t}"
        for t in ("customer", "orders", "lineitem", "events", "documents")
    ),
)
_add(
    "run_counts",
    """SELECT 'orders' AS table_name, count(*) AS run_rows, count(*) FILTER (o_orderstatus <> 'P') AS rest_rows
       FROM orders
       UNION ALL SELECT 'lineitem', count(*), NULL FROM lineitem
       UNION ALL SELECT 'supplier', NULL, count(*) FROM supplier""",
)
_add(
    "run_metrics",
    """SELECT count(*) AS rows, count(DISTINCT l_orderkey) AS orders, CAST(min(l_shipdate) AS DATE) AS first_shipped,
              CAST(max(l_shipdate) AS DATE) AS last_shipped,
              CAST(sum(CAST(l_extendedprice AS DECIMAL(19,4))) AS DECIMAL(29,4)) AS amount FROM lineitem""",
)

# --- streams
_add(
    "stream_gate",
    """SELECT count(*) FILTER (event_type <> 'error') AS held, count(*) AS expected FROM events
       HAVING count(*) <> count(*) FILTER (event_type <> 'error')""",
)
ORACLE["stream_upsert"] = ORACLE["latest_line"]
_add(
    "marker_refresh",
    """SELECT o_orderpriority, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(19,4))) AS DECIMAL(29,4)) AS total
       FROM orders GROUP BY 1""",
)


# --- refresh ----------------------------------------------------------------------------

_RESTATED = {
    "fx_rates": """SELECT currency, rate_date, CAST(CASE WHEN rate_date BETWEEN DATE '2024-01-16' AND DATE '2024-01-19'
                     THEN rate * 2 ELSE rate END AS DECIMAL(18,8)) AS rate FROM given"""
}
_DAILY_REVENUE = """SELECT order_date, country, count(DISTINCT order_id) AS orders, CAST(sum(quantity) AS BIGINT) AS units,
                           CAST(sum(amount_usd) AS DECIMAL(29,4)) AS revenue
                    FROM fct_orders o JOIN customers c ON o.customer_id = c.customer_id GROUP BY 1, 2"""
_TOTALS = """SELECT 'silver_fx_daily' AS table_name, count(*) AS n, CAST(sum(rate) AS DECIMAL(38,8)) AS total FROM fx_daily
  UNION ALL SELECT 'fct_orders', count(*), CAST(sum(amount_usd) AS DECIMAL(38,8)) FROM fct_orders
  UNION ALL SELECT 'fct_sales', count(*), CAST(sum(amount_usd) AS DECIMAL(38,8)) FROM fct_sales
  UNION ALL SELECT 'fct_daily_revenue', (SELECT count(*) FROM (SELECT DISTINCT o.order_date, c.country
    FROM fct_orders o JOIN customers c ON o.customer_id = c.customer_id)), CAST(sum(amount_usd) AS DECIMAL(38,8)) FROM fct_orders
  UNION ALL SELECT 'fct_revenue_summary', count(*), CAST(sum(revenue_usd) AS DECIMAL(38,8)) FROM summary
  UNION ALL SELECT 'dim_product', count(*), NULL FROM dim_product
  UNION ALL SELECT 'dim_date', count(*), NULL FROM dim_date"""
_TOTAL_READS = ("fx_daily", "fct_orders", "fct_sales", "customers", "summary", "dim_product", "dim_date")
_FX = "SELECT * FROM fx_daily"
ORACLE["product_refresh"] = f"""
WITH days AS (
  SELECT coalesce(a.rate_date, b.rate_date) AS day
  FROM ({_sql(_FX, "fx_daily")}) a FULL OUTER JOIN ({_sql(_FX, "fx_daily", instead=_RESTATED)}) b
    ON a.currency = b.currency AND a.rate_date = b.rate_date
  WHERE a.rate IS DISTINCT FROM b.rate GROUP BY 1
), parts AS (
  SELECT count(*) AS days, count(DISTINCT printf('FY%02d Q%d', (year(day) + (month(day) >= 4)::INTEGER) % 100,
    (month(day) + 8) % 12 // 3 + 1)) AS quarters FROM days
)
SELECT b.table_name,
  CASE WHEN b.table_name = 'silver_fx_daily' THEN 'rewritten' WHEN b.table_name LIKE 'dim_%' THEN 'equal' ELSE 'by parts' END AS action,
  CASE WHEN b.table_name = 'fct_revenue_summary' THEN quarters WHEN b.table_name LIKE 'fct_%' THEN days END AS parts,
  b.n AS rows_before, b.total AS total_before, a.n AS rows_after, a.total AS total_after
FROM ({_sql(_TOTALS, *_TOTAL_READS)}) b JOIN ({_sql(_TOTALS, *_TOTAL_READS, instead=_RESTATED)}) a ON a.table_name = b.table_name, parts
"""
ORACLE["refreshed_daily_revenue"] = _sql(_DAILY_REVENUE, "fct_orders", "customers", instead=_RESTATED)
_add("refused_refresh", _DAILY_REVENUE, "fct_orders", "customers")


def _missing(child: str, column: str, parent: str, key: str) -> str:
    return f"SELECT count(*) FROM {child} WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {key} FROM {parent} WHERE {key} IS NOT NULL)"


def _repeated(table: str, column: str) -> str:
    return f"SELECT count(*) FROM (SELECT 1 FROM {table} WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1)"


def _product_rules() -> list[tuple[str, str, str, str, str, str]]:
    """(table, rule, column, dimension, metric, violations) of every contract rule of the product."""
    source = {
        "silver_customers": "customers", "silver_orders": "pos_orders", "silver_web_customers": "accounts",
        "silver_web_order_lines": "web_lines", "silver_party": "parties", "silver_fx_daily": "fx_daily",
        "silver_product_hierarchy": "hierarchy", "dim_customer": "customers", "fct_revenue_summary": "summary",
        "fct_daily_revenue": "fct_orders",
    }
    unique = (
        ("silver_customers", "customer_id"), ("silver_web_customers", "account_id"), ("silver_party", "party_key"),
        ("silver_product_hierarchy", "product_id"), ("dim_customer", "customer_id"), ("dim_party", "party_key"),
        ("dim_country", "country"), ("dim_product", "product_id"), ("dim_date", "order_date"),
    )
    filled = unique + (
        ("silver_orders", "order_id"), ("silver_orders", "customer_id"),
        ("silver_orders", "order_date"), ("silver_orders", "amount"), ("silver_web_order_lines", "order_id"),
        ("silver_fx_daily", "currency"), ("silver_fx_daily", "rate"), ("silver_fx_daily", "is_carried"),
        ("dim_party", "customer_segment"), ("dim_country", "country_name"), ("fct_sales", "channel_system"),
        ("fct_sales", "party_key"), ("dim_product", "department"), ("dim_date", "fiscal_quarter_label"),
        ("fct_daily_revenue", "order_date"), ("fct_revenue_summary", "channel_system"),
        ("fct_revenue_summary", "revenue_usd"),
    )
    links = (
        ("silver_orders", "customer_id", "silver_customers", "customer_id"),
        ("silver_web_order_lines", "account_id", "silver_web_customers", "account_id"),
        ("fct_orders", "customer_id", "dim_customer", "customer_id"), ("fct_orders", "party_key", "dim_party", "party_key"),
        ("fct_sales", "party_key", "dim_party", "party_key"), ("fct_sales", "product_id", "dim_product", "product_id"),
        ("fct_sales", "order_date", "dim_date", "order_date"),
    )
    named = lambda table: source.get(table, table)
    rules = [(t, f"{c}_unique", c, "uniqueness", "duplicateValues", _repeated(named(t), c)) for t, c in unique]
    rules += [
        (t, f"{c}_not_null", c, "completeness", "nullValues", f"SELECT count(*) FROM {named(t)} WHERE {c} IS NULL")
        for t, c in filled
    ]
    rules += [
        (t, f"{c}_resolves_in_{p}", c, "consistency", "unresolvedKeys", _missing(named(t), c, named(p), k))
        for t, c, p, k in links
    ]
    rules += [
        ("silver_quarantine_orders", "quarantine_reasons_not_null", "quarantine_reasons", "completeness", "nullValues", "SELECT 0"),
        ("fct_sales", "channel_system_accepted", "channel_system", "conformity", "invalidValues",
         "SELECT count(*) FROM fct_sales WHERE channel_system NOT IN ('POS', 'WEB')"),
        ("silver_orders", "quantity_is_positive", "quantity", "validity", "invalidRows",
         "SELECT count(*) FROM pos_orders WHERE coalesce(quantity <= 0, TRUE)"),
        ("silver_fx_daily", "rate_is_positive", "rate", "validity", "invalidRows",
         "SELECT count(*) FROM fx_daily WHERE coalesce(rate <= 0, TRUE)"),
    ]
    return rules


_add(
    "dq_product",
    "SELECT *, TRUE AS evaluated, violations = 0 AS passed FROM ("
    + " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{r}' AS rule, '{c}' AS column_name, '{d}' AS dimension, "
        f"'{m}' AS metric, CAST(({q}) AS BIGINT) AS violations"
        for t, r, c, d, m, q in _product_rules()
    )
    + ")",
    "summary",
    "dim_country",
    "dim_date",
    "dim_product",
)

_add(
    "country_across",
    f"""SELECT coalesce(c.country, o.country, r.country) AS country_country,
              coalesce(c.country_name, o.country_name, r.country_name) AS country_country_name,
              customers, order_revenue, order_units, reported_revenue, reported_units,
              {_ratio("reported_revenue", "reported_units", "reported_per_unit")}
       FROM (SELECT d.country, d.country_name, count(*) AS customers
             FROM customers c LEFT JOIN dim_country d ON c.country = d.country GROUP BY ALL) c
       FULL JOIN (SELECT d.country, d.country_name, CAST(sum(amount_usd) AS DECIMAL(29,4)) AS order_revenue,
                         CAST(sum(quantity) AS BIGINT) AS order_units
                  FROM fct_orders o JOIN customers c ON o.customer_id = c.customer_id
                  LEFT JOIN dim_country d ON c.country = d.country GROUP BY ALL) o
         ON c.country IS NOT DISTINCT FROM o.country
       FULL JOIN (SELECT d.country, d.country_name, CAST(sum(revenue_usd) AS DECIMAL(29,4)) AS reported_revenue,
                         CAST(sum(units) AS BIGINT) AS reported_units
                  FROM summary s LEFT JOIN dim_country d ON s.country = d.country GROUP BY ALL) r
         ON coalesce(c.country, o.country) IS NOT DISTINCT FROM r.country""",
    "customers",
    "dim_country",
    "fct_orders",
    "summary",
)

_SURFACE = "fiscal_quarter_label, customer_segment, country, channel_system, department, product_segment"
_add(
    "reconcile_written",
    f"""SELECT {_SURFACE}, '' AS field, '' AS problem, revenue_usd AS left_value, revenue_usd AS right_value
       FROM summary WHERE FALSE""",
    "summary",
)
_add(
    "reconcile_planted",
    f"""SELECT {_SURFACE}, 'revenue' AS field, 'differs' AS problem,
               CAST(revenue_usd + 1 AS DECIMAL(29,4)) AS left_value, revenue_usd AS right_value
       FROM (SELECT *, row_number() OVER (ORDER BY coalesce(fiscal_quarter_label, ''), coalesce(customer_segment, ''),
               coalesce(country, ''), channel_system, coalesce(department, ''), coalesce(product_segment, '')) AS rn FROM summary)
       WHERE rn = 1 AND NOT coalesce(product_segment = 'Brand#15' AND channel_system = 'WEB', FALSE)
       UNION ALL
       SELECT {_SURFACE}, '', 'right only', NULL, NULL FROM summary
       WHERE product_segment = 'Brand#15' AND channel_system = 'WEB'""",
    "summary",
)
ORACLE["state_by_batches"] = ORACLE["current_state"]
ORACLE["history_by_batches"] = ORACLE["scd2"]
_add(
    "stream_exactly_once",
    """SELECT event_type AS kind, CASE WHEN ts < TIMESTAMP '2024-01-08' AND event_id % 10 = 0 THEN 'late' ELSE 'landed' END
         AS status, count(*) AS events
       FROM events GROUP BY 1, 2""",
)


def _amount(column: str) -> str:
    return f"CAST(sum(CAST({column} AS DECIMAL(19,4))) AS DECIMAL(29,4))"


ORACLE["observed_writes"] = f"""
SELECT 'orders' AS table_name, count(*) AS run_rows, {_amount("o_totalprice")} AS run_amount, count(*) AS rest_rows,
  {_amount("o_totalprice")} AS rest_amount FROM orders
UNION ALL SELECT 'lineitem', count(*), {_amount("l_extendedprice")}, count(*), {_amount("l_extendedprice")} FROM lineitem
UNION ALL SELECT 'customer', count(*), {_amount("c_acctbal")}, count(*) FILTER (c_mktsegment <> 'BUILDING'),
  CAST(sum(CAST(c_acctbal AS DECIMAL(19,4))) FILTER (c_mktsegment <> 'BUILDING') AS DECIMAL(29,4)) FROM customer
"""
# What each table of the product reads.
_READS = {
    "silver_customers": "customer nation",
    "latest_lines": "lineitem",
    "silver_orders": "latest_lines orders customer",
    "silver_quarantine_orders": "latest_lines",
    "silver_web_customers": "events supplier",
    "silver_web_order_lines": "events",
    "silver_party": "silver_customers silver_web_customers",
    "silver_fx_daily": "events",
    "silver_product_hierarchy": "part",
    "dim_customer": "silver_customers",
    "dim_party": "silver_party",
    "dim_country": "dim_party nation",
    "fct_orders": "silver_orders silver_fx_daily",
    "fct_sales": "fct_orders silver_web_order_lines silver_web_customers silver_fx_daily",
    "dim_product": "silver_product_hierarchy fct_sales",
    "dim_date": "fct_sales",
    "fct_daily_revenue": "dim_customer fct_orders",
    "fct_revenue_summary": "fct_sales dim_date dim_product dim_party",
}
_REBUILT = "silver_fx_daily fct_orders fct_sales dim_product dim_date fct_daily_revenue fct_revenue_summary"
ORACLE["product_lineage"] = " UNION ALL ".join(
    f"SELECT '{source}' AS source, '{target}' AS target, "
    + ("'version 2' AS producer, TRUE AS observed" if target in _REBUILT.split() else "'declared only' AS producer, FALSE AS observed")
    for target, reads in _READS.items()
    for source in reads.split()
)
