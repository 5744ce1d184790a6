"""The registered queries again, as SQL text for an independent engine.

The text is written from the meaning of each query, with other operators than
the plans use where possible (window functions for aggregates, sub-selects for
joins, a fold over a list for the stock), so that it can disagree with them.
"""

from __future__ import annotations

MONEY = "DECIMAL(18,2)"

FILM = f"""
    SELECT p_partkey AS film_id, p_name AS title, 1970 + p_size AS release_year,
           CAST(p_retailprice AS {MONEY}) AS rental_rate, p_size AS rental_duration,
           p_size AS length, p_brand AS rating, p_type AS category
    FROM part"""

RENTAL = f"""
    SELECT l_orderkey AS rental_id, l_partkey || '-' || l_suppkey AS inventory_id,
           l_partkey AS film_id, o_custkey AS customer_id, o_orderdate AS rental_date,
           CASE WHEN l_linestatus = 'F' THEN l_shipdate END AS return_date,
           CAST(l_extendedprice AS {MONEY}) AS amount
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

FIRST = "split_part({0}, '#', 1)"
LAST = "split_part({0}, '#', 2)"

PLAIN_AMOUNT = (
    "CASE WHEN abs({0}) < 1 THEN replace(printf('%.2f', CAST({0} AS DOUBLE)), '0.', '.')"
    " ELSE printf('%.2f', CAST({0} AS DOUBLE)) END"
)


def _amount(expression: str) -> str:
    return PLAIN_AMOUNT.format(expression)


def _double(expression: str) -> str:
    return f"CAST({expression} AS DOUBLE)"


_titles = f"""
SELECT title, release_year, {_double('rental_rate')} AS rental_rate
FROM ({FILM})
WHERE film_id IN (SELECT p_partkey FROM part WHERE lower(p_type) = 'promo')
  AND release_year BETWEEN 1990 AND 2010 AND rental_rate > 910
"""

_store_address = """
    SELECT s_suppkey AS store_id,
           n_name || coalesce(', ' || nullif(CASE r_name WHEN 'EUROPE' THEN '' WHEN 'ASIA' THEN NULL ELSE r_name END, ''), '')
               AS store_address
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""

_genres = """
SELECT 1970 + p_size AS release_year,
       count(*) FILTER (p_type = 'ECONOMY') AS number_of_economy,
       count(*) FILTER (p_type = 'PROMO') AS number_of_promo,
       count(*) FILTER (p_type = 'STANDARD') AS number_of_standard
FROM part WHERE p_type IN ('ECONOMY', 'PROMO', 'STANDARD') GROUP BY 1
"""


def _last_activity(only_stores: bool) -> str:
    only = "AND store_id IS NOT NULL" if only_stores else ""
    return f"""
WITH pay AS (
    SELECT o_custkey AS staff_id, CAST(o_totalprice AS {MONEY}) AS amount, o_orderdate AS d,
           CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderpriority[1] AS INTEGER) - 1 END AS store_id
    FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'
), used AS (SELECT * FROM pay WHERE true {only}),
revenue AS (SELECT staff_id, sum(amount) AS revenue FROM used GROUP BY 1),
last_rows AS (
    SELECT u.staff_id, r_regionkey, r_name FROM used u JOIN region ON r_regionkey = u.store_id
    WHERE u.d = (SELECT max(d) FROM used v WHERE v.staff_id = u.staff_id)
), last_store AS (
    SELECT staff_id, min(r_regionkey) AS last_store_id, min(r_name) AS last_store_address
    FROM last_rows GROUP BY 1
)
SELECT {FIRST.format('c_name')} AS first_name, {LAST.format('c_name')} AS last_name,
       {_double('revenue')} AS revenue, last_store_id, last_store_address
FROM customer JOIN revenue ON c_custkey = revenue.staff_id JOIN last_store USING (staff_id)
ORDER BY revenue DESC, last_name, first_name LIMIT 3
"""


_qualifying = """
    SELECT c_custkey, c_name,
           (SELECT count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_custkey = c_custkey) AS rental_count,
           (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS payment_count
    FROM customer"""

_top300 = f"""
WITH y AS (
    SELECT o_orderpriority AS channel_desc, o_custkey AS cust_id, year(o_orderdate) AS y,
           sum(CAST(o_totalprice AS {MONEY})) AS total
    FROM orders WHERE year(o_orderdate) IN (1998, 1999, 2001) GROUP BY ALL
), r AS (
    SELECT *, row_number() OVER (PARTITION BY channel_desc, y ORDER BY total DESC, cust_id) AS place FROM y
), t AS (SELECT * FROM r WHERE place <= 300)
SELECT channel_desc, cust_id, upper({LAST.format('any_value(c_name)')}) AS cust_last_name,
       upper({FIRST.format('any_value(c_name)')}) AS cust_first_name,
       {_amount('sum(total)')} AS amount_sold
FROM t JOIN customer ON c_custkey = cust_id
GROUP BY channel_desc, cust_id HAVING count(DISTINCT y) = 3
"""

_weeks = f"""
WITH d AS (
    SELECT CAST(o_orderdate AS DATE) AS time_id, sum(CAST(o_totalprice AS {MONEY})) AS sales
    FROM orders WHERE o_orderdate >= TIMESTAMP '1999-12-04' AND o_orderdate < TIMESTAMP '1999-12-28' GROUP BY 1
), w AS (
    SELECT week(time_id) AS calendar_week_number, time_id, dayname(time_id) AS day_name, sales,
        sum(sales) OVER (PARTITION BY week(time_id) ORDER BY time_id ROWS UNBOUNDED PRECEDING) AS cum_sum,
        CAST(sum(sales) OVER n AS DOUBLE) / count(*) OVER n AS plain_avg,
        CAST(sum(sales) OVER m AS DOUBLE) / count(*) OVER m AS monday_avg,
        CAST(sum(sales) OVER f AS DOUBLE) / count(*) OVER f AS friday_avg
    FROM d WINDOW
        n AS (ORDER BY time_id RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND INTERVAL 1 DAY FOLLOWING),
        m AS (ORDER BY time_id RANGE BETWEEN INTERVAL 2 DAY PRECEDING AND INTERVAL 1 DAY FOLLOWING),
        f AS (ORDER BY time_id RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND INTERVAL 2 DAY FOLLOWING)
)
SELECT calendar_week_number, CAST(time_id AS VARCHAR) AS time_id, day_name, {_double('sales')} AS sales, {{extra}}
FROM w WHERE calendar_week_number IN (49, 50, 51) AND time_id BETWEEN DATE '1999-12-06' AND DATE '1999-12-26'
"""

_days = f"""
WITH d AS (
    SELECT CAST(ts AS DATE) AS time_id, sum(CAST(value AS {MONEY})) AS sales FROM events
    WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2025-01-01' GROUP BY 1
)
SELECT CAST(time_id AS VARCHAR) AS time_id, dayname(time_id) AS day_name, {_double('sales')} AS sales, {{extra}}
FROM d
"""

_balance = f"""
WITH r AS ({RENTAL}),
f AS (
    SELECT customer_id, sum(CAST(p_retailprice AS {MONEY})) AS fees,
           sum(greatest(date_diff('day', CAST(rental_date AS DATE),
               CAST(coalesce(return_date, TIMESTAMP '2001-06-30') AS DATE)) - p_size, 0)) AS days
    FROM r JOIN part ON film_id = p_partkey WHERE rental_date < TIMESTAMP '2001-07-01' GROUP BY 1
), p AS (
    SELECT o_custkey AS customer_id, sum(CAST(o_totalprice AS {MONEY})) AS paid FROM orders
    WHERE o_orderdate < TIMESTAMP '2001-07-01' GROUP BY 1
)
SELECT c_custkey AS customer_id, {_double('coalesce(fees, 0)')} AS rental_fees,
       {_double('coalesce(days, 0) * 1.5')} AS overdue_fees, {_double('coalesce(paid, 0)')} AS payments,
       {_double('coalesce(fees, 0) + CAST(coalesce(days, 0) AS DECIMAL(18,0)) * 1.50 - coalesce(paid, 0)')} AS balance
FROM customer LEFT JOIN f ON f.customer_id = c_custkey LEFT JOIN p ON p.customer_id = c_custkey
"""

_in_stock_films = f"""
WITH r AS ({RENTAL}),
copies AS (SELECT inventory_id, film_id, bool_or(return_date IS NULL) AS is_out FROM r GROUP BY ALL),
matched AS (
    SELECT p_partkey AS film_id, p_name AS title, p_type AS language_name FROM part
    WHERE p_name ILIKE '%ring%' AND p_partkey IN (SELECT film_id FROM copies WHERE NOT is_out)
),
rows_ AS (
    SELECT DISTINCT m.film_id, m.title, m.language_name,
           {FIRST.format('c_name')} || ' ' || {LAST.format('c_name')} AS customer_name,
           strftime(r.rental_date, '%Y-%m-%d %H:%M:%S') AS rental_date
    FROM matched m JOIN r USING (film_id) JOIN customer ON c_custkey = r.customer_id
    WHERE r.rental_date = (SELECT max(x.rental_date) FROM r x WHERE x.film_id = m.film_id)
)
SELECT count(*) OVER (ORDER BY upper(title), film_id) AS row_num, title AS film_title,
       upper(language_name[1]) || lower(language_name[2:]) AS language, customer_name, rental_date
FROM rows_
"""

_change_products = """
    SELECT p_partkey AS product_id, p_name AS product_name, CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price,
           p_size * 10 AS stock_quantity, p_brand || ' ' || p_name AS product_display_name,
           TIMESTAMP '2000-01-01' AS created_at
    FROM part"""

_changes = f"""
    SELECT o_orderkey AS change_seq, o_custkey * 2 AS product_id,
           lower(trim(CASE WHEN o_orderpriority = '1-URGENT' THEN ' Product_Name '
                WHEN o_orderpriority = '2-HIGH' THEN 'unit_price'
                WHEN o_orderpriority = '3-MEDIUM' THEN 'STOCK_QUANTITY'
                WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'F' THEN 'warranty_months'
                WHEN o_orderpriority = '5-LOW' THEN 'product_display_name'
                ELSE 'created_at' END)) AS column_name,
           CASE WHEN o_orderpriority IN ('1-URGENT', '5-LOW') THEN ' New Name ' || o_orderkey || ' '
                WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'P' THEN 'n/a'
                WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus <> 'P' THEN ' ' || o_custkey
                WHEN o_orderpriority IN ('2-HIGH', '3-MEDIUM') THEN CAST(CAST(o_totalprice AS {MONEY}) AS VARCHAR)
                WHEN o_orderstatus = 'P' THEN 'not a date'
                ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS new_value
    FROM orders"""

_decided_changes = f"""
    SELECT *, CASE
        WHEN column_name = 'warranty_months' THEN 'column not allowed'
        WHEN new_value IN ('n/a', 'not a date') OR (column_name = 'stock_quantity' AND contains(new_value, '.'))
            THEN 'value does not convert'
        WHEN product_id NOT IN (SELECT p_partkey FROM part) THEN 'product not found' END AS reason
    FROM ({_changes})"""

_posting = """
WITH numbered AS (
    SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS seq
    FROM lineitem
), req AS (
    SELECT seq, 'TX-' || l_orderkey || '-' || l_linenumber AS transaction_number,
           (SELECT c_custkey FROM customer WHERE c_custkey = o_custkey AND c_acctbal >= 0) AS customer_id,
           (SELECT s_suppkey FROM supplier WHERE s_suppkey = l_suppkey AND s_acctbal >= 0) AS employee_id,
           CASE WHEN p_type <> 'PROMO' THEN p_partkey END AS product_id,
           p_size * 10 AS stock, CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price,
           CASE WHEN l_discount = 0 THEN 0 WHEN l_tax <> 0 THEN CAST(l_quantity AS INTEGER) END AS quantity,
           o_orderdate
    FROM numbered JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
), checked AS MATERIALIZED (
    SELECT *, CASE WHEN customer_id IS NULL THEN 'customer not found'
        WHEN employee_id IS NULL THEN 'employee not found'
        WHEN product_id IS NULL THEN 'product not found'
        WHEN quantity IS NULL OR quantity <= 0 THEN 'quantity must be greater than zero'
        WHEN transaction_number IN (SELECT 'TX-' || o_orderkey || '-1' FROM orders WHERE o_orderstatus = 'P')
            THEN 'transaction number already exists' END AS reason0
    FROM req
)"""

# Request by request: a step takes the requests that are next both in their product and under
# their number, and leaves what is left of the product's stock and whether the number is taken.
_posting = _posting.replace("WITH ", "WITH RECURSIVE ", 1) + """
, valid AS MATERIALIZED (
    SELECT seq, transaction_number AS number, product_id AS product, quantity, stock,
           row_number() OVER (PARTITION BY product_id ORDER BY seq) AS in_product,
           row_number() OVER (PARTITION BY transaction_number ORDER BY seq) AS in_number
    FROM checked WHERE reason0 IS NULL
), steps AS (
    SELECT 'product' AS kind, CAST(product AS VARCHAR) AS id, CAST(1 AS BIGINT) AS next,
           CAST(any_value(stock) AS BIGINT) AS val, FALSE AS claims, FALSE AS admitted FROM valid GROUP BY product
    UNION ALL
    SELECT 'number', number, 1, 0, FALSE, FALSE FROM valid GROUP BY number
    UNION ALL
    SELECT * FROM (
        WITH ready AS (
            SELECT v.seq, v.number, v.product, p.next AS p_next, n.next AS n_next, p.val AS rest, v.quantity,
                   n.val = 0 AS claims, n.val = 0 AND v.quantity <= p.val AS admitted
            FROM valid v
            JOIN steps p ON p.kind = 'product' AND p.id = CAST(v.product AS VARCHAR) AND p.next = v.in_product
            JOIN steps n ON n.kind = 'number' AND n.id = v.number AND n.next = v.in_number
        )
        SELECT 'product' AS kind, p.id, p.next + CASE WHEN r.seq IS NULL THEN 0 ELSE 1 END AS next,
               p.val - CASE WHEN r.admitted THEN r.quantity ELSE 0 END AS val, FALSE AS claims, FALSE AS admitted
        FROM steps p LEFT JOIN ready r ON p.id = CAST(r.product AS VARCHAR)
        WHERE p.kind = 'product' AND EXISTS (SELECT 1 FROM ready)
        UNION ALL
        SELECT 'number', n.id, n.next + CASE WHEN r.seq IS NULL THEN 0 ELSE 1 END,
               CASE WHEN r.admitted THEN r.seq ELSE n.val END, FALSE, FALSE
        FROM steps n LEFT JOIN ready r ON n.id = r.number
        WHERE n.kind = 'number' AND EXISTS (SELECT 1 FROM ready)
        UNION ALL
        SELECT 'request', CAST(seq AS VARCHAR), seq, 0, claims, admitted FROM ready
    )
), fate AS MATERIALIZED (
    SELECT next AS seq, claims, admitted FROM steps WHERE kind = 'request'
), decided AS (
    SELECT checked.*, CASE WHEN reason0 IS NOT NULL THEN reason0
        WHEN NOT fate.claims THEN 'transaction number already exists'
        WHEN NOT fate.admitted THEN 'not enough stock' END AS reason
    FROM checked LEFT JOIN fate ON checked.seq = fate.seq
), posted AS (
    SELECT *, (SELECT max(o_orderkey) FROM orders) + row_number() OVER (ORDER BY seq) AS sales_transaction_id
    FROM decided WHERE reason IS NULL
)
"""


def _rule_rows(table: str, source: str, rules: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{name}' AS rule_name, count(*) AS checked_rows,"
        f" count(*) FILTER ({broken}) AS violations FROM {source}"
        for name, broken in rules.items()
    )


_rules = " UNION ALL ".join([
    _rule_rows("customer", "customer", {
        "name not null": "c_name IS NULL",
        "name not blank": "length(trim(c_name)) = 0",
        "name in normal form": "c_name <> lower(trim(c_name))",
        "balance not negative": "c_acctbal < 0",
        "segment in domain": "c_mktsegment NOT IN ('HOUSEHOLD', 'MACHINERY')",
    }),
    _rule_rows("orders", "orders", {
        "closed date not null": "o_orderstatus <> 'F'",
        "closed after 1996": "o_orderstatus = 'F' AND o_orderdate <= TIMESTAMP '1996-12-31'",
        "status in domain": "o_orderstatus = 'P'",
        "price positive": "o_totalprice <= 0",
    }),
    _rule_rows("lineitem", "lineitem", {
        "quantity positive": "l_quantity <= 0",
        "discount at most 5 percent": "l_discount > CAST(0.05 AS DOUBLE)",
        "shipped after 1995": "l_shipdate <= TIMESTAMP '1995-12-31'",
    }),
    _rule_rows("part", "part", {
        "brand length": "length(p_brand) > 7",
        "size range": "p_size < 1 OR p_size > 49",
    }),
])

# Favourites are parts of size 3 and 4; those of size 4 are films already.
_load = """
WITH fav AS (SELECT * FROM part WHERE p_size IN (3, 4)),
pairs AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem JOIN fav ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey),
me AS (SELECT min(k) AS k FROM (
    SELECT o_custkey AS k FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1 HAVING count(*) >= 8)),
mine AS (SELECT count(*) AS n FROM orders JOIN me ON o_custkey = k),
step AS (
    SELECT 'film' AS name, (SELECT count(*) FROM fav WHERE p_size = 3) AS row_count
    UNION ALL SELECT 'film_category', (SELECT count(*) FROM fav)
    UNION ALL SELECT 'actor', (SELECT count(DISTINCT l_suppkey) FROM pairs JOIN supplier ON l_suppkey = s_suppkey WHERE s_acctbal < 0)
    UNION ALL SELECT 'film_actor', (SELECT count(*) FROM pairs)
    UNION ALL SELECT 'inventory', (SELECT count(*) FROM fav)
    UNION ALL SELECT 'customer', (SELECT count(k) FROM me)
    UNION ALL SELECT 'deleted_payment', (SELECT n FROM mine)
    UNION ALL SELECT 'deleted_rental', (SELECT n FROM mine)
    UNION ALL SELECT 'rental', (SELECT count(*) FROM fav)
    UNION ALL SELECT 'payment', (SELECT count(*) FROM fav)
)
"""

ORACLE: dict[str, str] = {
    "filter_join_sort": _titles,
    "in_subquery": _titles,
    "join_address": f"""
SELECT store_address, {_double(f'sum(CAST(l_extendedprice AS {MONEY}))')} AS revenue
FROM lineitem JOIN ({_store_address}) ON store_id = l_suppkey
WHERE l_shipdate >= TIMESTAMP '1997-04-01' GROUP BY 1
""",
    "revenue_by_store": f"""
SELECT store_id, store_address, {_double(f'sum(CAST(l_extendedprice AS {MONEY}))')} AS revenue
FROM lineitem JOIN ({_store_address}) ON store_id = l_suppkey
WHERE l_shipdate >= TIMESTAMP '1997-04-01' GROUP BY 1, 2
""",
    "topn_count": f"""
SELECT {FIRST.format('s_name')} AS first_name, {LAST.format('s_name')} AS last_name,
       count(DISTINCT l_partkey) AS number_of_movies
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
WHERE 1970 + p_size >= 2015
GROUP BY s_suppkey, s_name ORDER BY 3 DESC, 2, 1, s_suppkey LIMIT 5
""",
    "genre_pivot_case": _genres,
    "genre_pivot_leftjoins": _genres,
    "last_activity": _last_activity(False),
    "last_activity_in_stores": _last_activity(True),
    "top_rented_mapped": """
SELECT p_name AS title, count(*) AS number_of_rentals,
       CASE p_brand WHEN 'Brand#1' THEN 'All ages' WHEN 'Brand#2' THEN '13+' WHEN 'Brand#3' THEN '17+'
           WHEN 'Brand#4' THEN '18+' ELSE 'Unknown' END AS expected_age
FROM lineitem JOIN part ON l_partkey = p_partkey
GROUP BY p_partkey, p_name, p_brand ORDER BY 2 DESC, 1, p_partkey LIMIT 5
""",
    "inactivity_years": f"""
SELECT {FIRST.format('s_name')} AS first_name, {LAST.format('s_name')} AS last_name,
       max(1970 + p_size) AS latest_release_year, 2026 - max(1970 + p_size) AS inactivity_years
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
GROUP BY s_suppkey, s_name
""",
    "max_gap_years": f"""
WITH y AS (SELECT DISTINCT l_suppkey, p_size FROM lineitem JOIN part ON l_partkey = p_partkey),
g AS (SELECT l_suppkey, (SELECT min(n.p_size) FROM y n WHERE n.l_suppkey = y.l_suppkey AND n.p_size > y.p_size) - p_size AS gap FROM y)
SELECT {FIRST.format('s_name')} AS first_name, {LAST.format('s_name')} AS last_name, max(gap) AS max_gap_years
FROM g JOIN supplier ON l_suppkey = s_suppkey WHERE gap IS NOT NULL GROUP BY s_suppkey, s_name
""",
    "max_gap_days": f"""
WITH d AS (SELECT DISTINCT l_suppkey, CAST(l_shipdate AS DATE) AS d FROM lineitem),
g AS (SELECT l_suppkey, lead(d) OVER (PARTITION BY l_suppkey ORDER BY d) - d AS gap FROM d)
SELECT {FIRST.format('s_name')} AS first_name, {LAST.format('s_name')} AS last_name, max(gap) AS max_gap_days
FROM g JOIN supplier ON l_suppkey = s_suppkey WHERE gap IS NOT NULL GROUP BY s_suppkey, s_name
""",
    "two_child_threshold": f"""
SELECT c_custkey AS customer_id, upper({FIRST.format('c_name')}) AS first_name,
       upper({LAST.format('c_name')}) AS last_name, rental_count, payment_count
FROM ({_qualifying}) WHERE rental_count >= 43 AND payment_count >= 18
""",
    "share_lag": f"""
WITH c AS (
    SELECT r_regionkey, r_name, year(o_orderdate) AS y, o_orderpriority AS ch,
           sum(CAST(o_totalprice AS {MONEY})) AS amount
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
         JOIN region ON n_regionkey = r_regionkey
    WHERE year(o_orderdate) BETWEEN 1998 AND 2001 AND r_name IN ('AMERICA', 'ASIA', 'EUROPE')
    GROUP BY ALL
), s AS (
    SELECT *, round(CAST(amount AS DOUBLE) / CAST(sum(amount) OVER (PARTITION BY r_regionkey, y) AS DOUBLE) * 100, 2) AS pct FROM c
), p AS (
    SELECT *, lag(pct) OVER (PARTITION BY r_regionkey, ch ORDER BY y) AS before FROM s
)
SELECT r_name AS country_region, y AS calendar_year, ch AS channel_desc,
       format('{{:,}}', CAST(round(amount, 0) AS BIGINT)) || ' $' AS amount_sold,
       printf('%.2f', pct) || ' %' AS "% BY CHANNELS",
       printf('%.2f', before) || ' %' AS "% PREVIOUS PERIOD",
       replace(printf('%.2f', round(pct - before, 2)), '-0.00', '0.00') || ' %' AS "% DIFF"
FROM p WHERE y BETWEEN 1999 AND 2001
""",
    "top5_share": f"""
WITH c AS (
    SELECT o_orderpriority AS ch, o_custkey, sum(CAST(o_totalprice AS {MONEY})) AS total FROM orders GROUP BY ALL
), r AS (
    SELECT *, row_number() OVER (PARTITION BY ch ORDER BY total DESC, o_custkey) AS place,
           sum(total) OVER (PARTITION BY ch) AS channel_total FROM c
), s AS (
    SELECT *, round(CAST(total AS DOUBLE) / CAST(channel_total AS DOUBLE) * 100, 4) AS share FROM r WHERE place <= 5
)
SELECT ch AS channel_desc, upper({LAST.format('c_name')}) AS cust_last_name,
       upper({FIRST.format('c_name')}) AS cust_first_name, {_amount('total')} AS amount_sold,
       CASE WHEN share < 1 THEN replace(printf('%.4f', share), '0.', '.') ELSE printf('%.4f', share) END || ' %' AS sales_percentage
FROM s JOIN customer ON c_custkey = o_custkey
""",
    "top300_all_years": _top300,
    "top300_join_form": _top300,
    "crosstab_quarters": f"""
WITH f AS (
    SELECT p_name, quarter(o_orderdate) AS q, CAST(l_extendedprice AS {MONEY}) AS a
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
         JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
         JOIN region ON n_regionkey = r_regionkey
    WHERE p_type = 'PROMO' AND r_name = 'ASIA' AND year(o_orderdate) = 2000
), w AS (
    SELECT p_name, coalesce(sum(a) FILTER (q = 1), 0) AS q1, coalesce(sum(a) FILTER (q = 2), 0) AS q2,
           coalesce(sum(a) FILTER (q = 3), 0) AS q3, coalesce(sum(a) FILTER (q = 4), 0) AS q4, sum(a) AS total
    FROM f GROUP BY 1
)
SELECT p_name AS product_name, {_amount('q1')} AS q1, {_amount('q2')} AS q2, {_amount('q3')} AS q3,
       {_amount('q4')} AS q4, {_amount('total')} AS year_sum FROM w
""",
    "region_columns": f"""
WITH f AS (
    SELECT strftime(o_orderdate, '%Y-%m') AS m, p_type, r_name, CAST(l_extendedprice AS {MONEY}) AS a
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
         JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
         JOIN region ON n_regionkey = r_regionkey
    WHERE year(o_orderdate) = 2000 AND month(o_orderdate) <= 3 AND r_name IN ('AMERICA', 'EUROPE')
), s AS (
    SELECT m, p_type, coalesce(sum(CASE WHEN r_name = 'AMERICA' THEN a END), 0) AS a,
           coalesce(sum(CASE WHEN r_name = 'EUROPE' THEN a END), 0) AS e FROM f GROUP BY 1, 2
)
SELECT m AS calendar_month_desc, p_type AS prod_category, {_amount('a')} AS america_sales, {_amount('e')} AS europe_sales FROM s
""",
    "weekly_cumsum": _weeks.format(extra=f"{_double('cum_sum')} AS cum_sum"),
    "centered_avg": _weeks.format(
        extra="round(CASE day_name WHEN 'Monday' THEN monday_avg WHEN 'Friday' THEN friday_avg"
        " ELSE plain_avg END, 2) AS centered_3_day_avg"
    ),
    "rows_frame": _days.format(
        extra="CAST(sum(sales) OVER (ORDER BY time_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS DOUBLE)"
        " AS three_row_running_sales"
    ),
    "range_frame": _days.format(
        extra="round(CAST(sum(sales) OVER r AS DOUBLE) / count(*) OVER r, 6) AS date_range_centered_average"
    )
    + " WINDOW r AS (ORDER BY time_id RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND INTERVAL 1 DAY FOLLOWING)",
    "groups_frame": f"""
WITH c AS (
    SELECT year(o_orderdate) AS y, o_orderpriority AS ch, sum(CAST(o_totalprice AS {MONEY})) AS a
    FROM orders WHERE year(o_orderdate) BETWEEN 1999 AND 2001 GROUP BY ALL
)
SELECT y AS calendar_year, ch AS channel_desc, {_double('a')} AS amount_sold,
       CAST(sum(a) OVER (ORDER BY y GROUPS BETWEEN 1 PRECEDING AND CURRENT ROW) AS DOUBLE) AS current_and_previous_year_sales
FROM c
""",
    "rows_frame_of_lines": f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {_double(f'CAST(l_extendedprice AS {MONEY})')} AS amount,
       {_double(f'sum(CAST(l_extendedprice AS {MONEY})) OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)')} AS three_line_sum
FROM lineitem
""",
    "range_frame_of_lines": f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {_double(f'CAST(l_extendedprice AS {MONEY})')} AS amount,
       CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS day,
       {_double(f'sum(CAST(l_extendedprice AS {MONEY})) OVER r')} AS neighbour_days_sum,
       count(*) OVER r AS neighbour_days_lines
FROM lineitem WINDOW r AS (ORDER BY CAST(l_shipdate AS DATE)
    RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND INTERVAL 1 DAY FOLLOWING)
""",
    "groups_frame_of_lines": f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {_double(f'CAST(l_extendedprice AS {MONEY})')} AS amount,
       CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS day,
       {_double(f'sum(CAST(l_extendedprice AS {MONEY})) OVER (ORDER BY CAST(l_shipdate AS DATE) GROUPS BETWEEN 1 PRECEDING AND CURRENT ROW)')} AS two_dates_sum
FROM lineitem
""",
    "last_reduced_price": f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {_double(f'CAST(l_extendedprice AS {MONEY})')} AS amount, l_returnflag,
       {_double(f'last_value(CASE WHEN l_discount > 0 THEN CAST(l_extendedprice AS {MONEY}) END IGNORE NULLS) OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)')} AS last_reduced
FROM lineitem
""",
    "top5000_lines": f"""
SELECT * FROM (
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {_double(f'CAST(l_extendedprice AS {MONEY})')} AS amount, l_returnflag,
           CAST(row_number() OVER (PARTITION BY l_returnflag ORDER BY CAST(l_extendedprice AS {MONEY}) DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS INTEGER) AS place
    FROM lineitem) WHERE place <= 5000
""",
    "latest_quarter": f"""
WITH q AS (SELECT CAST(date_trunc('quarter', max(o_orderdate)) AS DATE) AS start FROM orders)
SELECT CAST(start AS VARCHAR) AS quarter_start_date, strftime(o_orderdate, '%Y-%m') AS transaction_month,
       p_type AS category_name, p_name AS product_name, p_brand AS brand_name,
       p_name || ' ' || p_partkey AS model_name, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total_units_sold,
       {_double(f'sum(CAST(l_extendedprice AS {MONEY}))')} AS total_revenue,
       count(DISTINCT o_orderkey) AS total_transactions
FROM orders JOIN q ON o_orderdate >= start AND o_orderdate < start + INTERVAL 3 MONTH
     JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
GROUP BY ALL
""",
    "values_lookup": f"""
WITH v(region_name, segment) AS (VALUES ('america', 'household'), ('asia', 'machinery'), ('europe', 'furniture'),
    ('middle east', 'household'), ('atlantis', 'building'), ('africa', 'automobile'))
SELECT r_name, c_mktsegment, 0 AS home_nation, count(*) AS customers,
       {_double(f'sum(CAST(c_acctbal AS {MONEY}))')} AS balance,
       CASE r_name WHEN 'AMERICA' THEN '2017-01-10' WHEN 'ASIA' THEN '2017-02-11' WHEN 'EUROPE' THEN '2017-03-12' END AS start_date
FROM v JOIN region ON lower(r_name) = region_name JOIN nation ON n_regionkey = r_regionkey
     JOIN customer ON c_nationkey = n_nationkey AND lower(c_mktsegment) = segment
GROUP BY r_name, c_mktsegment
""",
    "unnest_distinct": """
WITH n AS (
    SELECT DISTINCT lower(trim(x)) AS name FROM (SELECT unnest([' Asia', 'ASIA ', 'europe', '', '   ', NULL, 'Atlantis', 'Africa']) AS x)
    WHERE trim(x) <> ''
)
SELECT name, (SELECT count(*) FROM customer JOIN nation ON c_nationkey = n_nationkey
              JOIN region ON n_regionkey = r_regionkey WHERE lower(r_name) = name) AS customers
FROM n
""",
    "series_delete_third": """
SELECT 'VEEEEEEERY_LONG_STRING' || n AS col
FROM (SELECT unnest(generate_series(o_orderkey * 2 + 1, o_orderkey * 2 + 2)) AS n FROM orders) WHERE n % 3 <> 0
""",
    "or_groups": f"""
SELECT p_name, p_size, count(*) AS lines, {_double(f'sum(CAST(l_extendedprice AS {MONEY}))')} AS amount
FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1999-07-01'
  AND ((p_name = 'red plate' AND p_size <= 20) OR (p_name = 'small widget' AND p_size > 30)
       OR (p_name = 'hot ring' AND p_size < 45))
GROUP BY 1, 2
""",
    "anti_orders": """
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
WHERE l_orderkey IS NULL
""",
    "null_safe_latest": """
WITH l AS (SELECT l_orderkey, CASE WHEN l_linestatus = 'F' THEN l_shipdate END AS returned FROM lineitem),
m AS (SELECT l_orderkey, max(returned) AS latest FROM l GROUP BY 1)
SELECT l_orderkey, count(*) AS lines, coalesce(strftime(latest, '%Y-%m-%d %H:%M:%S'), '-') AS returned,
       concat('order ', l_orderkey, ' ', strftime(latest, '%Y-%m')) AS label
FROM l JOIN m USING (l_orderkey) WHERE returned IS NOT DISTINCT FROM latest GROUP BY l_orderkey, latest
""",
    "peer_numbering": "SELECT p_partkey, p_name, count(*) OVER (ORDER BY upper(p_name)) AS row_num FROM part",
    "string_agg_ordered": """
SELECT p_type, string_agg(p_brand, ',' ORDER BY p_brand) AS brands
FROM part GROUP BY 1
""",
    "string_agg_distinct": """
SELECT p_type, string_agg(p_brand, ',' ORDER BY p_brand) AS brands
FROM (SELECT DISTINCT p_type, p_brand FROM part) GROUP BY 1
""",
    "quarter_by_date": f"""
SELECT upper(p_type) AS category_name, {_double(f'sum(CAST(l_extendedprice AS {MONEY}))')} AS total_sales_revenue
FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE date_trunc('quarter', l_shipdate) = date_trunc('quarter', DATE '2000-02-15') GROUP BY p_type
""",
    "quarter_as_of": f"""
SELECT upper(p_type) AS category_name, {_double(f'sum(CAST(l_extendedprice AS {MONEY}))')} AS total_sales_revenue
FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE l_shipdate >= TIMESTAMP '2001-04-01' AND l_shipdate < TIMESTAMP '2001-07-01' GROUP BY p_type
""",
    "best_per_group_tiebreak": f"""
WITH s AS (
    SELECT lower(n_name) AS name, p_name, p_brand, p_type, p_size, count(*) AS n,
           sum(CAST(l_extendedprice AS {MONEY})) AS revenue
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
         JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey
    GROUP BY ALL
), b AS (SELECT *, rank() OVER (PARTITION BY name ORDER BY n DESC, revenue DESC, upper(p_name)) AS place FROM s),
names AS (SELECT lower(n_name) AS name FROM nation UNION SELECT 'atlantis')
SELECT CASE WHEN names.name = 'atlantis' THEN 'Atlantis' ELSE 'Nation_' || split_part(names.name, '_', 2) END AS country,
       coalesce(p_name, '-') AS film, coalesce(upper(p_brand), '-') AS rating,
       coalesce(upper(p_type[1]) || lower(p_type[2:]), '-') AS language,
       coalesce(CAST(p_size AS VARCHAR), '-') AS length, coalesce(CAST(1970 + p_size AS VARCHAR), '-') AS release_year
FROM names LEFT JOIN b ON b.name = names.name AND place = 1
""",
    "like_in_stock": _in_stock_films,
    "like_not_found": """
SELECT CAST(1 AS BIGINT) AS row_num, 'Movie not found or not currently in stock' AS film_title,
       '-' AS language, '-' AS customer_name, '-' AS rental_date
WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_name ILIKE '%zzzzzzzznomatch%')
""",
    "in_stock": f"""
SELECT inventory_id, film_id, l_suppkey AS store_id, count(*) FILTER (return_date IS NULL) = 0 AS in_stock,
       min(customer_id) FILTER (return_date IS NULL) AS held_by
FROM (SELECT *, CAST(split_part(inventory_id, '-', 2) AS BIGINT) AS l_suppkey FROM ({RENTAL})) GROUP BY 1, 2, 3
""",
    "not_in_stock": "SELECT DISTINCT l_partkey || '-' || l_suppkey AS inventory_id FROM lineitem WHERE l_linestatus = 'O'",
    "customer_balance": _balance,
    "rewards_report": f"""
SELECT o_custkey AS customer_id, count(*) AS payment_count, {_double(f'sum(CAST(o_totalprice AS {MONEY}))')} AS amount_spent
FROM orders WHERE date_trunc('month', o_orderdate) = (SELECT date_trunc('month', max(o_orderdate)) FROM orders)
GROUP BY 1 HAVING count(*) >= 1 AND sum(CAST(o_totalprice AS {MONEY})) >= 100000
""",
    "insert_if_absent": """
WITH c AS (SELECT DISTINCT p_name, p_brand, 'old' AS origin, p_size FROM part WHERE p_size <= 10)
SELECT * FROM c UNION ALL
SELECT DISTINCT upper(p_name), p_brand, 'new', (SELECT max(p_size) FROM part) FROM part
WHERE NOT EXISTS (SELECT 1 FROM c WHERE upper(c.p_name) = upper(part.p_name) AND c.p_brand = part.p_brand)
""",
    "insert_explicit_null": """
SELECT p_partkey, CASE WHEN p_type = 'PROMO' OR p_brand <> 'Brand#13' THEN p_brand END AS brand,
       CASE WHEN p_type = 'PROMO' THEN 'old' ELSE 'new' END AS origin FROM part
""",
    "update_from_repeated": f"""
SELECT c_custkey AS customer_id, {FIRST.format('c_name')} AS first_name,
       coalesce((SELECT min(o_orderpriority) FROM orders WHERE o_custkey = c_custkey), {LAST.format('c_name')}) AS last_name,
       c_nationkey AS country_id FROM customer
""",
    "on_conflict_nothing": f"""
WITH o AS (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_partkey, l_suppkey, CAST(l_extendedprice AS {MONEY})) AS place
    FROM lineitem WHERE l_linestatus = 'O'
)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {_double(f'CAST(l_extendedprice AS {MONEY})')} AS price
FROM o WHERE place = 1 AND NOT EXISTS (SELECT 1 FROM lineitem f WHERE f.l_linestatus = 'F'
    AND f.l_orderkey = o.l_orderkey AND f.l_linenumber = o.l_linenumber)
""",
    "update_from": f"""
WITH who AS (SELECT min(c_custkey) AS k FROM ({_qualifying}) WHERE rental_count >= 43 AND payment_count >= 18)
SELECT c_custkey AS customer_id, CASE WHEN c_custkey = k THEN 'NEW' ELSE {FIRST.format('c_name')} END AS first_name,
       CASE WHEN c_custkey = k THEN 'OWNER' ELSE {LAST.format('c_name')} END AS last_name,
       CASE WHEN c_custkey = k THEN 0 ELSE c_nationkey END AS country_id,
       CASE WHEN c_custkey = k THEN '2026-01-01' END AS last_update
FROM customer, who
""",
    "update_latest_row": """
SELECT o_orderkey, CASE WHEN o_orderkey = m THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderkey = m THEN '0-NONE' ELSE o_orderpriority END AS o_orderpriority
FROM orders, (SELECT max(o_orderkey) AS m FROM orders)
""",
    "delete_preview": """
SELECT 'PAYMENT' AS table_name, count(*) AS rows_to_delete FROM orders WHERE o_custkey = 7
UNION ALL SELECT 'RENTAL', count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_custkey = 7
""",
    "delete_using": f"""
WITH l AS (SELECT 'lines' AS table_name, o_custkey = 7 AS mine, CAST(l_extendedprice AS {MONEY}) AS amount
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
o AS (SELECT 'orders' AS table_name, o_custkey = 7 AS mine, CAST(o_totalprice AS {MONEY}) AS amount FROM orders),
states(table_name, state, mine) AS (VALUES ('lines', 'deleted', true), ('lines', 'left', false),
    ('orders', 'deleted', true), ('orders', 'left', false)),
a AS (SELECT * FROM l UNION ALL SELECT * FROM o)
SELECT table_name, state, count(amount) AS row_count, {_double('coalesce(sum(amount), 0)')} AS amount
FROM states LEFT JOIN a USING (table_name, mine) GROUP BY 1, 2
""",
    "delete_returning": """
SELECT o_orderkey, o_custkey AS customer_id, o_orderstatus, CAST(o_orderdate AS VARCHAR) AS o_orderdate
FROM orders WHERE o_custkey = 7
""",
    "generated_columns": f"""
SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS INTEGER) AS quantity,
       {_double('CAST(l_extendedprice AS DECIMAL(10,2))')} AS unit_price,
       {_double('CAST(l_quantity AS INTEGER) * CAST(l_extendedprice AS DECIMAL(10,2))')} AS line_total,
       'order ' || l_orderkey || ' - ' || l_linenumber AS display_name
FROM lineitem
""",
    "surrogate_keys": """
WITH n AS (
    SELECT DISTINCT l_partkey, l_suppkey FROM lineitem o WHERE l_linestatus = 'O' AND NOT EXISTS (
        SELECT 1 FROM lineitem f WHERE f.l_linestatus = 'F' AND f.l_partkey = o.l_partkey AND f.l_suppkey = o.l_suppkey)
)
SELECT l_partkey, l_suppkey, (SELECT max(o_orderkey) FROM orders) + row_number() OVER (ORDER BY l_partkey, l_suppkey) AS copy_id
FROM n
""",
    "column_change_log": f"""
WITH a AS (SELECT * FROM ({_decided_changes}) WHERE reason IS NULL),
l AS (SELECT product_id, column_name, max_by(new_value, change_seq) AS v FROM a GROUP BY 1, 2),
p AS ({_change_products})
SELECT p.product_id,
       coalesce((SELECT lower(trim(v)) FROM l WHERE l.product_id = p.product_id AND column_name = 'product_name'), product_name) AS product_name,
       CAST(coalesce((SELECT CAST(v AS DECIMAL(10,2)) FROM l WHERE l.product_id = p.product_id AND column_name = 'unit_price'), unit_price) AS DOUBLE) AS unit_price,
       coalesce((SELECT CAST(trim(v) AS INTEGER) FROM l WHERE l.product_id = p.product_id AND column_name = 'stock_quantity'), stock_quantity) AS stock_quantity,
       coalesce((SELECT lower(trim(v)) FROM l WHERE l.product_id = p.product_id AND column_name = 'product_display_name'), product_display_name) AS product_display_name,
       CAST(coalesce((SELECT CAST(v AS TIMESTAMP) FROM l WHERE l.product_id = p.product_id AND column_name = 'created_at'), created_at) AS VARCHAR) AS created_at
FROM p
""",
    "column_change_rejects": f"SELECT * FROM ({_decided_changes}) WHERE reason IS NOT NULL",
    "post_sales": _posting
    + "SELECT seq, transaction_number, customer_id, product_id, quantity, reason FROM decided",
    "post_sales_lines": _posting
    + "SELECT sales_transaction_id, transaction_number, product_id, quantity, CAST(unit_price AS DOUBLE) AS unit_price,"
    " CAST(quantity * unit_price AS DOUBLE) AS line_total FROM posted",
    "post_sales_headers": _posting
    + "SELECT sales_transaction_id, transaction_number, customer_id, employee_id,"
    " CAST(o_orderdate AS VARCHAR) AS transaction_date, 'pending' AS transaction_status,"
    " 'card' AS payment_method FROM posted",
    "post_sales_stock": _posting
    + "SELECT p_partkey AS product_id, p_size * 10 - CAST(coalesce((SELECT sum(quantity) FROM decided d"
    " WHERE d.product_id = p_partkey AND d.reason IS NULL), 0) AS BIGINT) AS stock_quantity"
    " FROM part WHERE p_type <> 'PROMO'",
    "validate_new_items": """
WITH cat AS (SELECT lower(p_name || ' ' || p_brand) AS t FROM part WHERE p_size <= 10),
p AS (
    SELECT p_partkey AS seq, CASE WHEN p_brand = 'Brand#13' THEN '' ELSE upper(p_name || ' ' || p_brand) END AS title,
           CASE WHEN p_size <> 12 THEN 1860 + p_size * 4 END AS release_year,
           ' Nation_' || (p_size - length(p_name)) AS language FROM part
), c AS (
    SELECT p.*, n_name, CASE WHEN title = '' THEN 'title is blank'
        WHEN release_year < 1888 OR release_year > 2031 THEN 'year is not valid'
        WHEN n_name IS NULL THEN 'language is unknown'
        WHEN lower(title) IN (SELECT t FROM cat) THEN 'title already exists' END AS r
    FROM p LEFT JOIN nation ON lower(n_name) = lower(trim(language))
)
SELECT seq, title, coalesce(release_year, 2026) AS release_year, coalesce(n_name, language) AS language,
       CASE WHEN r IS NULL AND row_number() OVER (PARTITION BY title, r IS NULL ORDER BY seq) > 1
            THEN 'title already exists' ELSE r END AS reason
FROM c
""",
    "new_items_inserted": """
WITH f AS (SELECT p_partkey AS film_id, lower(p_name || ' ' || p_brand) AS t FROM part WHERE p_size <= 10),
p AS (
    SELECT p_partkey AS seq, upper(p_name || ' ' || p_brand) AS title,
           CASE WHEN p_size <> 12 THEN 1860 + p_size * 4 END AS release_year FROM part
), ok AS (
    SELECT min(seq) AS seq, title FROM p
    WHERE (release_year IS NULL OR release_year BETWEEN 1888 AND 2031) AND lower(title) NOT IN (SELECT t FROM f)
    GROUP BY title
)
SELECT (SELECT max(film_id) FROM f) + row_number() OVER (ORDER BY seq) AS film_id, p.title,
       'Inserted via core.new_movie()' AS description, coalesce(release_year, 2026) AS release_year,
       (SELECT min(n_nationkey) FROM nation WHERE lower(n_name) = 'nation_3') AS language_id,
       CAST(NULL AS INTEGER) AS original_language_id, 3 AS rental_duration, CAST(4.99 AS DOUBLE) AS rental_rate,
       90 AS length, CAST(19.99 AS DOUBLE) AS replacement_cost, 'PG' AS rating, '2026-01-01' AS last_update,
       'Trailers' AS special_features
FROM ok JOIN p USING (seq)
""",
    "series_table": """
SELECT count(*) AS row_count, min(n) AS first_number, max(n) AS last_number,
       CAST(sum(length('NUMBERED_TEXT' || n)) AS BIGINT) AS characters
FROM (SELECT unnest(range(1, (SELECT count(*) FROM orders) + 1)) AS n) WHERE n % 3 <> 0
""",
    "append_reordered": """
SELECT o_orderkey AS order_id, o_orderstatus AS status,
       CASE WHEN o_orderstatus = 'P' THEN o_orderpriority ELSE 'appended' END AS origin FROM orders
""",
    "truncate_and_refill": """
SELECT count(*) AS before, 0 AS truncated, count(*) FILTER (l_linenumber = 1) AS refilled FROM lineitem
""",
    "payments_of_a_month": f"""
SELECT o_orderkey AS payment_id, o_custkey AS customer_id, {_double(f'CAST(o_totalprice AS {MONEY})')} AS amount,
       '1997-04' AS month FROM orders WHERE strftime(o_orderdate, '%Y-%m') = '1997-04'
""",
    "changed_months": f"""
WITH p AS (
    SELECT o_custkey, strftime(o_orderdate, '%Y-%m') AS month, CAST(o_totalprice AS {MONEY}) AS amount, c_nationkey
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey)
SELECT month, count(*) AS payments,
       {_double("sum(amount + CASE WHEN month = '1997-04' AND c_nationkey < 5 THEN 1 ELSE 0 END)")} AS amount
FROM p WHERE month <> '1998-06' AND NOT (month = '1998-05' AND o_custkey % 2 = 0) GROUP BY month
""",
    "bucketed_priority_revenue": f"""
SELECT o_orderkey, o_orderpriority, count(*) AS lines, {_double(f'sum(CAST(l_extendedprice AS {MONEY}))')} AS amount
FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2
""",
    "store_revenue_chain": f"""
WITH r AS (SELECT l_orderkey, (min({{'p': l_partkey, 's': l_suppkey}})).s AS store_id FROM lineitem GROUP BY 1)
SELECT store_id, store_address, {_double(f'sum(CAST(o_totalprice AS {MONEY}))')} AS revenue
FROM orders JOIN r ON o_orderkey = l_orderkey JOIN ({_store_address}) USING (store_id)
WHERE o_orderdate >= TIMESTAMP '1997-04-01' GROUP BY 1, 2
""",
    "in_stock_by_film_and_store": f"""
WITH c AS (SELECT l_partkey || '-' || l_suppkey AS inventory_id, l_partkey AS f, l_suppkey AS s,
                  bool_or(l_linestatus <> 'F') AS is_out FROM lineitem GROUP BY 1, 2, 3)
SELECT 'store' AS asked, inventory_id FROM c WHERE NOT is_out AND s = 7
UNION ALL SELECT 'film', inventory_id FROM c WHERE NOT is_out AND f = 7
UNION ALL SELECT 'film out', inventory_id FROM c WHERE is_out AND f = 7
UNION ALL SELECT 'film and store', inventory_id FROM c WHERE NOT is_out AND f = 7 AND s = 7
""",
    "copy_holders": f"""
SELECT inventory_id, min(customer_id) FILTER (return_date IS NULL) AS held_by FROM ({RENTAL}) GROUP BY 1
""",
    "load_steps": _load + "SELECT 1 AS run, name, row_count FROM step UNION ALL SELECT 2, name, 0 FROM step",
    "load_tables": _load + """
SELECT name, old + coalesce((SELECT row_count FROM step s WHERE s.name = t.name), 0)
         - coalesce((SELECT row_count FROM step s WHERE s.name = 'deleted_' || t.name), 0) AS row_count
FROM (
    SELECT 'language' AS name, (SELECT count(*) FROM nation) AS old
    UNION ALL SELECT 'address', (SELECT count(*) FROM nation)
    UNION ALL SELECT 'category', (SELECT count(DISTINCT p_type) FROM part)
    UNION ALL SELECT 'film', (SELECT count(*) FROM part WHERE p_size > 3)
    UNION ALL SELECT 'film_category', (SELECT count(*) FROM part WHERE p_size > 4)
    UNION ALL SELECT 'actor', (SELECT count(*) FROM supplier WHERE s_acctbal >= 0)
    UNION ALL SELECT 'film_actor', (SELECT count(*) FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size > 4))
    UNION ALL SELECT 'inventory', (SELECT count(*) FROM part WHERE p_size > 4)
    UNION ALL SELECT 'store', (SELECT count(*) FROM supplier WHERE s_suppkey <= 2)
    UNION ALL SELECT 'customer', (SELECT count(*) FROM customer) - (SELECT count(k) FROM me)
    UNION ALL SELECT 'rental', (SELECT count(*) FROM orders)
    UNION ALL SELECT 'payment', (SELECT count(*) FROM orders)
) t
""",
    "dq_check_rules": _rules,
    "dq_unique": """
SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
""",
    "dq_unique_single": """
SELECT p_name AS name, count(*) AS row_count FROM part WHERE p_size <> 1 GROUP BY 1 HAVING count(*) > 1
""",
    "dq_orphans": """
SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus <> 'P'
  AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
""",
    "dq_orphans_self": """
WITH o AS (SELECT s_suppkey, nullif(s_suppkey // 10, 0) AS head_office FROM supplier WHERE s_acctbal >= 0)
SELECT * FROM o WHERE head_office NOT IN (SELECT s_suppkey FROM o)
""",
    "dq_orphans_self_parts": """
WITH o AS (SELECT p_partkey, nullif(p_partkey // 10, 0) AS head FROM part WHERE p_size > 10)
SELECT * FROM o WHERE head NOT IN (SELECT p_partkey FROM o)
""",
    "delete_nation_cascade": """
WITH RECURSIVE s AS (SELECT *, nullif(s_suppkey // 4, 0) AS head FROM supplier),
n AS (SELECT n_nationkey AS k FROM nation WHERE n_name = 'NATION_3'),
su AS (SELECT s_suppkey AS k FROM s WHERE s_nationkey IN (FROM n)
       UNION SELECT s_suppkey FROM s JOIN su ON head = k),
c AS (SELECT c_custkey AS k FROM customer WHERE c_nationkey IN (FROM n)),
o AS (SELECT o_orderkey AS k FROM orders WHERE o_custkey IN (FROM c)),
l AS (SELECT * FROM lineitem WHERE l_orderkey IN (FROM o) OR l_suppkey IN (FROM su)),
t AS (
    SELECT 0 AS step, 'lineitem' AS table_name, (SELECT count(*) FROM l) AS d, (SELECT count(*) FROM lineitem) AS n
    UNION ALL SELECT 1, 'supplier', (SELECT count(*) FROM su), (SELECT count(*) FROM supplier)
    UNION ALL SELECT 2, 'orders', (SELECT count(*) FROM o), (SELECT count(*) FROM orders)
    UNION ALL SELECT 3, 'customer', (SELECT count(*) FROM c), (SELECT count(*) FROM customer)
    UNION ALL SELECT 4, 'nation', (SELECT count(*) FROM n), (SELECT count(*) FROM nation)
    UNION ALL SELECT 5, 'region', 0, (SELECT count(*) FROM region))
SELECT step, table_name, d AS deleted_rows, n - d AS rows_left FROM t
""",
    "offices_below": """
WITH RECURSIVE s AS (SELECT s_suppkey, nullif(s_suppkey // 4, 0) AS head FROM supplier),
b AS (SELECT greatest(min(s_suppkey), 1) AS s_suppkey, 0 AS depth FROM s
      UNION ALL SELECT s.s_suppkey, depth + 1 FROM s JOIN b ON s.head = b.s_suppkey)
SELECT s_suppkey, depth FROM b
""",
    "fk_set_null": """
SELECT c_custkey, CASE WHEN r_name <> 'ASIA' THEN c_nationkey END AS c_nationkey
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""",
    "completeness": """
WITH t AS (
    SELECT 'customer' AS table_name, count(*) AS total_rows, count(*) FILTER (c_acctbal >= 0) AS set_rows FROM customer
    UNION ALL SELECT 'orders', count(*), count(*) FILTER (o_orderstatus <> 'P') FROM orders
    UNION ALL SELECT 'lineitem', count(*), count(*) FILTER (l_linestatus = 'F') FROM lineitem
    UNION ALL SELECT 'part', count(*), count(*) FILTER (p_type <> 'PROMO') FROM part
)
SELECT 'before' AS stage, * FROM t UNION ALL SELECT 'after', table_name, total_rows, total_rows FROM t
""",
    "row_policy": f"""
WITH me AS (SELECT min(c_custkey) AS k FROM customer WHERE c_custkey IN (
    SELECT o_custkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey))
SELECT o_orderkey AS payment_id, o_custkey AS customer_id, {_double(f'CAST(o_totalprice AS {MONEY})')} AS amount,
       CAST(o_orderdate AS VARCHAR) AS payment_date
FROM orders JOIN me ON o_custkey = k
""",
    "row_policy_denied": """
WITH me AS (SELECT min(c_custkey) AS k FROM customer WHERE c_custkey IN (
    SELECT o_custkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey)),
other AS (SELECT min(o_custkey) AS o FROM orders, me WHERE o_custkey <> k)
SELECT o_custkey AS customer_id, count(*) AS actual_rows, count(*) FILTER (o_custkey = k) AS visible_rows
FROM orders, me, other WHERE o_custkey IN (k, o) GROUP BY 1
""",
    "column_policy": f"""
SELECT c_custkey AS customer_id, lower({FIRST.format('c_name')}) AS first_name, lower({LAST.format('c_name')}) AS last_name
FROM customer
""",
    "scalar_text": f"""
SELECT c_custkey, upper(c_name) AS upper_name, lower(c_name) AS lower_name, left(c_name, 5) AS left_name,
       length(c_name) AS name_length, replace(c_name, '#', ' ') AS replaced, c_mktsegment AS trimmed,
       upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) || '''S Big-Deal 1st ' || upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS title_case,
       concat(nullif(c_mktsegment, 'HOUSEHOLD'), '/', c_nationkey) AS null_skipped,
       nullif(c_mktsegment, 'HOUSEHOLD') || '/' AS null_passed,
       CASE WHEN c_mktsegment = 'MACHINERY' THEN c_name ELSE c_name || ', ' || c_mktsegment END AS merged,
       c_mktsegment ILIKE '%hold' AS is_household,
       {_double(f'round(CAST(c_acctbal AS {MONEY}) * CAST(0.125 AS DECIMAL(4,3)), 2)')} AS eighth,
       2 AS pair_size
FROM customer
""",
    "scalar_date": """
SELECT o_orderkey, CAST(CAST(date_trunc('quarter', o_orderdate) AS DATE) AS VARCHAR) AS quarter_start,
       strftime(o_orderdate, '%Y-%m') AS month_label,
       strftime(o_orderdate + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS hour_later,
       strftime(o_orderdate + INTERVAL 7 DAY, '%Y-%m-%d %H:%M:%S') AS week_later,
       CAST(CAST(CAST(o_orderdate AS DATE) + INTERVAL 3 MONTH AS DATE) AS VARCHAR) AS quarter_later,
       CAST(CAST(o_orderdate AS DATE) - 82 AS VARCHAR) AS days_before,
       CAST(last_day(CAST(o_orderdate AS DATE)) AS VARCHAR) AS month_end,
       year(o_orderdate) AS year, quarter(o_orderdate) AS quarter, month(o_orderdate) AS month,
       week(o_orderdate) AS week, dayname(o_orderdate) AS day_name,
       date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') AS days_since
FROM orders
""",
    "scalar_masks": f"""
WITH p AS (SELECT o_orderkey, CAST(o_totalprice AS {MONEY}) AS a FROM orders)
SELECT o_orderkey, {_amount('a')} AS plain, format('{{:,}}', CAST(round(a, 0) AS BIGINT)) AS grouped,
       CAST(CAST(round(CAST(a AS DECIMAL(38,10)) * 0.000001, 2) AS DECIMAL(18,2)) AS VARCHAR) || ' %' AS percent,
       CASE WHEN a < 1000 THEN replace(CAST(CAST(round(CAST(a AS DECIMAL(38,10)) * 0.001, 4) AS DECIMAL(18,4)) AS VARCHAR), '0.', '.')
            ELSE CAST(CAST(round(CAST(a AS DECIMAL(38,10)) * 0.001, 4) AS DECIMAL(18,4)) AS VARCHAR) END || ' %' AS plain_percent,
       10000000 + o_orderkey AS shifted
FROM p
""",
}
