"""Oracle SQL per named query, for an independent engine over the same Parquet tables.

Sums of money are sums of whole cents, as in the library. Written from the meaning of each
report: windows, correlated subqueries and plain joins where the library uses
pre-aggregation, positions or unions.
"""

from __future__ import annotations

# Common table expressions shared by several queries.
_LINES = """
lines AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_partkey AS item_id, l_suppkey AS supplier_id,
         CAST(l_quantity AS BIGINT) AS quantity,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS amount_cents,
         CAST(floor(round(l_extendedprice * 100) / l_quantity + 0.5) AS BIGINT) AS unit_cents,
         CAST(l_shipdate AS DATE) AS ship_date, l_returnflag AS return_flag
  FROM lineitem)"""
_HEADS = """
heads AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
         o_orderstatus AS status, o_orderpriority AS priority,
         CAST(round(o_totalprice * 100) AS BIGINT) AS total_cents
  FROM orders)"""
_BOTH = f"WITH {_LINES}, {_HEADS}"

_MONTH_RU = """CASE month(order_date) WHEN 1 THEN 'Январь' WHEN 2 THEN 'Февраль' WHEN 3 THEN 'Март'
  WHEN 4 THEN 'Апрель' WHEN 5 THEN 'Май' WHEN 6 THEN 'Июнь' WHEN 7 THEN 'Июль' WHEN 8 THEN 'Август'
  WHEN 9 THEN 'Сентябрь' WHEN 10 THEN 'Октябрь' WHEN 11 THEN 'Ноябрь' WHEN 12 THEN 'Декабрь' END"""


def _orders_without_lines() -> str:
    return """
SELECT o_orderkey AS order_id, o_custkey AS customer_id FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)"""


_PRICE_OR_QUANTITY = f"""
{_BOTH}
SELECT l.order_id, strftime(order_date, '%d.%m.%Y') AS order_date_text, {_MONTH_RU} AS month_name,
       CAST(quarter(order_date) AS INTEGER) AS quarter,
       CAST((month(order_date) - 1) // 4 + 1 AS INTEGER) AS third, c_name AS customer_name
FROM lines l LEFT JOIN heads h ON h.order_id = l.order_id LEFT JOIN customer ON c_custkey = customer_id
WHERE unit_cents > 6000000 OR (quantity > 20 AND status = 'F')"""

_NAME_MONTHS = f"""
{_BOTH}
, months AS (
  SELECT year(order_date) AS y, month(order_date) AS m, p_name AS item_name, sum(amount_cents) AS cents,
         min(order_date) AS first_sale, sum(quantity) AS pieces
  FROM lines l LEFT JOIN heads h ON h.order_id = l.order_id LEFT JOIN part ON p_partkey = item_id
  GROUP BY ALL)"""

_RUNNING = f"""
{_BOTH}
, sums AS (
  SELECT h.order_id, customer_id, order_date, last_day(order_date) AS month, sum(amount_cents) AS cents
  FROM lines l JOIN heads h ON h.order_id = l.order_id WHERE order_date >= DATE '1999-01-01'
  GROUP BY ALL)
, months AS (SELECT month, sum(cents) AS cents FROM sums GROUP BY month)"""
_RUNNING_OUT = """
SELECT order_date, c_name AS customer_name, order_id, s.cents / 100.0::DOUBLE AS order_sum,
       r.running / 100.0::DOUBLE AS running_sum
FROM sums s LEFT JOIN running r ON r.month = s.month LEFT JOIN customer ON c_custkey = customer_id"""

_INSERTED = """
WITH inserted AS (
  SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
  UNION ALL
  SELECT (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY name), name, c_nationkey, c_acctbal, c_mktsegment
  FROM (SELECT 'Test customer name ' || c_custkey AS name, * FROM customer ORDER BY c_custkey LIMIT 5))"""

_PARTIES = """
WITH target AS (SELECT * FROM customer WHERE c_acctbal >= 0)
, source AS (
  SELECT c_name, c_nationkey, c_acctbal + 1 AS c_acctbal FROM customer
  UNION ALL SELECT s_name, s_nationkey, s_acctbal FROM supplier)
, fresh AS (
  SELECT (SELECT max(c_custkey) FROM target) + row_number() OVER (ORDER BY c_name) AS c_custkey, *
  FROM source WHERE c_name NOT IN (SELECT c_name FROM target))"""

_STOCK = """
WITH stock AS (
  SELECT p_partkey AS StockItemID, p_name || ' & ' || p_partkey AS StockItemName,
         CAST(replace(p_brand, 'Brand#', '') AS INTEGER) AS SupplierID, p_size AS UnitPackageID, 7 AS OuterPackageID,
         CAST(length(p_type) AS INTEGER) AS QuantityPerOuter, p_size / 10.0::DOUBLE AS TypicalWeightPerUnit,
         p_size AS LeadTimeDays, CAST(p_name LIKE 'cold%' AS INTEGER) AS IsChillerStock,
         15.0::DOUBLE AS TaxRate, p_retailprice AS UnitPrice
  FROM part)"""
_STOCK_FRESH = f"""
{_STOCK}
, fresh AS (
  SELECT (SELECT max(StockItemID) FROM stock WHERE UnitPackageID <= 40)
         + row_number() OVER (ORDER BY StockItemName) AS new_id, *
  FROM stock WHERE UnitPackageID > 40)"""

_TAGS = """
WITH tagged AS (
  SELECT p_partkey AS item_id, p_name AS item_name, p_brand, p_type,
         split_part(p_name, ' ', 1) AS tag1, split_part(p_name, ' ', 2) AS tag2,
         p_name LIKE 'hot%' AS cut, p_name LIKE 'old%' OR p_name LIKE 'new%' AS untagged
  FROM part)"""

_CLIENTS = """
clients AS (
  SELECT c_custkey + 1 AS id_client, c_name AS client_name, DATE '1995-01-01' AS create_date,
         DATE '2099-01-01' AS valid_to, c_mktsegment = 'BUILDING' AS is_del
  FROM customer WHERE c_acctbal >= 0)"""
_ACCOUNTS = """
accounts AS (
  SELECT c_custkey + 1001 AS id_account, 'A' || c_custkey AS account_name, c_custkey + 1 AS id_client,
         CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment || ' of nation ' || c_nationkey END AS account_description,
         CASE WHEN c_mktsegment = 'BUILDING' THEN 2 ELSE 3 END AS id_bal2
  FROM customer)"""
_NEW_CLIENTS = f"""
WITH {_CLIENTS}
, added AS (
  SELECT (SELECT max(id_client) FROM clients) + row_number() OVER (ORDER BY client_name) AS id_client, client_name
  FROM (SELECT DISTINCT c_name AS client_name FROM orders JOIN customer ON c_custkey = o_custkey
        WHERE c_name NOT IN (SELECT client_name FROM clients)))"""

_RECONCILE = f"""
{_BOTH}
, base AS (
  SELECT order_id, order_date AS carry_date, customer_id + 1 AS id_client, customer_id + 1001 AS id_account,
         CAST(left(priority, 1) AS BIGINT) AS id_agreement, status AS carry_ground,
         'nation=' || c_nationkey AS extra_data, total_cents AS cents
  FROM heads JOIN customer ON c_custkey = customer_id)
, incoming AS (
  SELECT carry_date, id_client, id_account, id_agreement, carry_ground, extra_data, sum(cents) AS new_cents
  FROM base GROUP BY ALL HAVING sum(cents) <> 0)
, stored AS (
  SELECT carry_date, id_client, id_account, id_agreement, carry_ground, extra_data, sum(cents) AS old_cents FROM (
    SELECT carry_date, id_client, id_account, id_agreement, carry_ground, extra_data,
           CASE WHEN carry_ground = 'O' THEN cents + 100 ELSE cents END AS cents
    FROM base WHERE carry_ground <> 'P'
    UNION ALL
    SELECT carry_date, id_client, id_account, id_agreement, 'return', extra_data, -r.cents
    FROM base b JOIN (SELECT order_id, sum(amount_cents) AS cents FROM lines WHERE return_flag = 'R' GROUP BY order_id) r
      ON r.order_id = b.order_id)
  GROUP BY ALL HAVING sum(cents) <> 0)
, compared AS (
  SELECT * FROM incoming FULL JOIN stored
    USING (carry_date, id_client, id_account, id_agreement, carry_ground, extra_data)
  WHERE new_cents IS DISTINCT FROM old_cents)
, emitted AS (
  SELECT carry_date, id_client, id_account, id_agreement, carry_ground, extra_data, 'reversal' AS action,
         -old_cents / 100.0::DOUBLE AS vl, false AS is_del
  FROM compared WHERE old_cents IS NOT NULL
  UNION ALL
  SELECT carry_date, id_client, id_account, id_agreement, carry_ground, extra_data, 'insert',
         new_cents / 100.0::DOUBLE, false
  FROM compared WHERE new_cents IS NOT NULL)"""

_REQUESTS = """
WITH requests AS (
  SELECT event_id AS request_id,
         CASE WHEN event_type = 'error' THEN -1 - user_id ELSE user_id END AS customer_id,
         CAST(CAST(ts AS DATE) - INTERVAL 336 MONTH AS DATE) AS begin_date,
         CAST(CAST(ts AS DATE) - INTERVAL 336 MONTH
              + CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) * INTERVAL 1 DAY AS DATE) AS end_date
  FROM events)
, counted AS (
  SELECT r.*, (SELECT count(*) FROM orders WHERE o_custkey = r.customer_id
               AND CAST(o_orderdate AS DATE) BETWEEN r.begin_date AND r.end_date) AS counter
  FROM requests r)"""

_BILLING = f"""
{_BOTH}
, invoices AS (
  SELECT h.order_id, customer_id, order_date + CASE WHEN status = 'P' THEN 1 ELSE 0 END AS invoice_date, bill_to_id
  FROM heads h JOIN customer c ON c_custkey = customer_id
  JOIN (SELECT c_nationkey AS nk, c_mktsegment AS seg, min(c_custkey) AS bill_to_id FROM customer GROUP BY ALL)
    ON nk = c_nationkey AND seg = c_mktsegment)
, totals AS (
  SELECT customer_id FROM lines l JOIN heads h ON h.order_id = l.order_id
  GROUP BY customer_id HAVING sum(amount_cents) > 200000000)
SELECT o.customer_id, d.item_id, CAST(sum(d.unit_cents) AS DOUBLE) / 100 AS sum_unit_price,
       CAST(sum(d.quantity) AS BIGINT) AS sum_quantity, count(o.order_id) AS order_count
FROM heads o JOIN lines d ON d.order_id = o.order_id
JOIN invoices i ON i.order_id = o.order_id
JOIN heads t ON t.order_id = i.order_id
JOIN lines mv ON mv.item_id = d.item_id
JOIN part ON p_partkey = d.item_id AND p_brand = 'Brand#12'
WHERE i.bill_to_id <> o.customer_id AND i.invoice_date = o.order_date
  AND i.customer_id IN (SELECT customer_id FROM totals)
GROUP BY o.customer_id, d.item_id"""

_INVOICES_OF = f"""
{_BOTH}
SELECT c_custkey AS customer_id, s.order_id, s.order_date, s.cents / 100.0::DOUBLE AS invoice_sum
FROM customer LEFT JOIN (
  SELECT customer_id, h.order_id, order_date, sum(amount_cents) AS cents
  FROM heads h JOIN lines l ON l.order_id = h.order_id GROUP BY ALL) s ON s.customer_id = c_custkey"""

_BEST = f"""
{_BOTH}
, best AS (SELECT order_id, sum(amount_cents) AS cents FROM lines GROUP BY order_id ORDER BY cents DESC, order_id LIMIT 1)"""

_PURCHASES = f"""
{_BOTH}
, bought AS (
  SELECT customer_id, l.order_id, line_no, item_id, supplier_id, unit_cents, order_date
  FROM lines l JOIN heads h ON h.order_id = l.order_id)"""

_CHEAPEST = "SELECT p_partkey AS item_id, p_name AS item_name, p_retailprice AS price FROM part ORDER BY p_retailprice, p_partkey LIMIT 10"


def _payers(direction: str) -> str:
    return f"""
SELECT c_mktsegment AS segment, c_name AS customer_name, max_amount
FROM (SELECT o_custkey, max(o_totalprice) AS max_amount FROM orders GROUP BY o_custkey
      ORDER BY max_amount {direction}, o_custkey LIMIT 5) JOIN customer ON c_custkey = o_custkey"""


def _nation_pivot() -> str:
    cells = ", ".join(f"sum(CASE WHEN n_name = 'NATION_{i}' THEN 1 END)::BIGINT AS NATION_{i}" for i in range(25))
    return f"""
SELECT strftime(date_trunc('month', o_orderdate), '%d.%m.%Y') AS invoice_month, {cells}
FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey GROUP BY 1"""


def _segment_pivot() -> str:
    names = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    cells = ", ".join(f"sum(CASE WHEN c_mktsegment = '{s}' THEN 1 END)::BIGINT AS {s}" for s in names)
    return f"""
SELECT strftime(date_trunc('month', o_orderdate), '%d.%m.%Y') AS invoice_month, {cells}
FROM orders LEFT JOIN customer ON c_custkey = o_custkey GROUP BY 1"""


# the orders of one month with a cent more
_DELTA = """
WITH month_orders AS (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) + 1 AS cents FROM orders
                      WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1997-01-31')
"""

ORACLE: dict[str, str] = {
    "items_by_name_pattern": """
SELECT p_partkey AS item_id, p_name AS item_name FROM part WHERE p_name LIKE '%ring%' OR p_name LIKE 'red%'""",
    "entities_without_children": _orders_without_lines(),
    "entities_without_children_full": _orders_without_lines(),
    "entities_without_children_not_in": _orders_without_lines(),
    "orders_price_or_quantity": _PRICE_OR_QUANTITY,
    "orders_price_or_quantity_page": _PRICE_OR_QUANTITY + """
ORDER BY quarter(order_date), (month(order_date) - 1) // 4, order_date, l.order_id LIMIT 100 OFFSET 1000""",
    "orders_price_or_quantity_deep_page": _PRICE_OR_QUANTITY + """
ORDER BY quarter(order_date), (month(order_date) - 1) // 4, order_date, l.order_id LIMIT 100 OFFSET 2000""",
    "orders_page_walk": f"""
WITH {_HEADS}
SELECT order_id, heads.order_date, customer_id, total_cents FROM heads JOIN orders ON o_orderkey = order_id
ORDER BY o_orderdate DESC NULLS LAST, order_id LIMIT 500 OFFSET 1000""",
    "expected_deliveries": f"""
{_BOTH}
SELECT s_name AS supplier_name, priority AS delivery_method, ship_date AS delivery_date, c_name AS contact_name
FROM lines l JOIN heads h ON h.order_id = l.order_id LEFT JOIN supplier ON s_suppkey = supplier_id
LEFT JOIN customer ON c_custkey = customer_id
WHERE ship_date BETWEEN DATE '1997-01-01' AND DATE '1997-01-31' AND trim(priority) IN ('1-URGENT', '2-HIGH') AND status = 'F'""",
    "last_sales_with_ties": f"""
{_BOTH}
, ranked AS (SELECT *, rank() OVER (ORDER BY order_date DESC) AS r FROM heads)
SELECT r.order_id, order_date, c_name AS customer_name,
       (SELECT s_name FROM supplier WHERE s_suppkey = (SELECT min(supplier_id) FROM lines l WHERE l.order_id = r.order_id)) AS seller_name
FROM ranked r LEFT JOIN customer ON c_custkey = customer_id WHERE r.r <= 10""",
    "buyers_of_item": """
SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS segment
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey LEFT JOIN customer ON c_custkey = o_custkey
LEFT JOIN part ON p_partkey = l_partkey WHERE p_name = 'red ring'""",
    "sellers_without_sale_on_day": """
SELECT s_suppkey AS supplier_id, s_name AS supplier_name FROM supplier
WHERE s_suppkey NOT IN (SELECT l_suppkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey
                        WHERE CAST(o_orderdate AS DATE) = DATE '1998-07-04')""",
    "cheapest_items": _CHEAPEST,
    "cheapest_items_in": _CHEAPEST,
    "items_at_minimal_price": """
SELECT p_partkey AS item_id, p_name AS item_name, p_retailprice AS price FROM part
WHERE p_retailprice = (SELECT min(p_retailprice) FROM part)""",
    "largest_payers": _payers("DESC"),
    "largest_payers_ascending": _payers("ASC"),
    "cities_of_dearest_items": f"""
{_BOTH}
, picked AS (SELECT order_id, customer_id FROM heads WHERE status = 'F')
, dear AS (SELECT item_id FROM lines WHERE order_id IN (SELECT order_id FROM picked)
           GROUP BY item_id ORDER BY max(unit_cents) DESC, item_id LIMIT 3)
, chosen AS (SELECT DISTINCT p.order_id, customer_id FROM picked p JOIN lines l ON l.order_id = p.order_id
             WHERE item_id IN (SELECT item_id FROM dear))
SELECT DISTINCT n_nationkey AS city_id, n_name AS city_name, s_name AS packer_name
FROM chosen c JOIN lines l ON l.order_id = c.order_id LEFT JOIN customer ON c_custkey = customer_id
LEFT JOIN supplier ON s_suppkey = supplier_id LEFT JOIN nation ON n_nationkey = c_nationkey""",
    "large_invoices_with_picked_total": f"""
{_BOTH}
SELECT h.order_id, order_date,
       (SELECT s_name FROM supplier WHERE s_suppkey = t.seller) AS seller_name,
       t.cents / 100.0::DOUBLE AS invoice_sum,
       CASE WHEN status = 'F' THEN (SELECT sum(amount_cents) FROM lines l WHERE l.order_id = h.order_id) / 100.0::DOUBLE END AS picked_sum
FROM heads h JOIN (SELECT order_id, sum(amount_cents) AS cents, min(supplier_id) AS seller FROM lines
                   GROUP BY order_id HAVING sum(amount_cents) > 40000000) t ON t.order_id = h.order_id""",
    "monthly_price_and_sales": f"""
{_BOTH}
SELECT CAST(year(order_date) AS INTEGER) AS date_year, CAST(month(order_date) AS INTEGER) AS date_month,
       sum(amount_cents) / 100.0::DOUBLE AS month_sum,
       CAST(sum(amount_cents) AS DOUBLE) / CAST(sum(quantity) * 100 AS DOUBLE) AS month_mean_price
FROM lines l LEFT JOIN heads h ON h.order_id = l.order_id GROUP BY 1, 2""",
    "months_over_threshold": f"""
{_BOTH}
SELECT CAST(year(order_date) AS INTEGER) AS date_year, CAST(month(order_date) AS INTEGER) AS date_month,
       sum(amount_cents) / 100.0::DOUBLE AS month_sum
FROM lines l LEFT JOIN heads h ON h.order_id = l.order_id GROUP BY 1, 2 HAVING sum(amount_cents) > 4200000000""",
    "slow_items_by_month": f"""
{_NAME_MONTHS}
SELECT CAST(y AS INTEGER) AS date_year, CAST(m AS INTEGER) AS date_month, item_name, cents / 100.0::DOUBLE AS month_sum,
       first_sale, CAST(pieces AS BIGINT) AS month_quantity
FROM months WHERE pieces < 200""",
    "months_zero_filled": f"""
{_BOTH}
, calendar AS (
  SELECT CAST(unnest(generate_series(date_trunc('month', (SELECT min(order_date) FROM heads)),
                                     date_trunc('month', (SELECT max(order_date) FROM heads)), INTERVAL 1 MONTH)) AS DATE) AS month)
, sold AS (
  SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, sum(amount_cents) AS cents
  FROM lines l JOIN heads h ON h.order_id = l.order_id JOIN part ON p_partkey = item_id
  WHERE p_name = 'red ring' AND p_brand = 'Brand#7' GROUP BY 1)
SELECT CAST(year(c.month) AS INTEGER) AS date_year, CAST(month(c.month) AS INTEGER) AS date_month,
       coalesce(cents, 0) / 100.0::DOUBLE AS month_sum
FROM calendar c LEFT JOIN sold s ON s.month = c.month""",
    "slow_items_zero_filled": f"""
{_BOTH}
, sold AS (
  SELECT item_id, CAST(date_trunc('month', order_date) AS DATE) AS month, sum(amount_cents) AS cents, sum(quantity) AS pieces
  FROM lines l JOIN heads h ON h.order_id = l.order_id GROUP BY 1, 2)
, calendar AS (
  SELECT item_id, CAST(unnest(generate_series(a::TIMESTAMP, b::TIMESTAMP, INTERVAL 1 MONTH)) AS DATE) AS month
  FROM (SELECT item_id, min(month) AS a, max(month) AS b FROM sold GROUP BY item_id))
SELECT CAST(year(c.month) AS INTEGER) AS date_year, CAST(month(c.month) AS INTEGER) AS date_month, c.item_id,
       coalesce(cents, 0) / 100.0::DOUBLE AS month_sum, CAST(coalesce(pieces, 0) AS BIGINT) AS month_quantity
FROM calendar c LEFT JOIN sold s ON s.item_id = c.item_id AND s.month = c.month
WHERE coalesce(pieces, 0) < 10""",
    "running_month_total_selfjoin": _RUNNING + """
, running AS (SELECT a.month, sum(b.cents) AS running FROM months a JOIN months b ON b.month <= a.month GROUP BY a.month)"""
    + _RUNNING_OUT,
    "running_month_total_window": _RUNNING + """
, running AS (SELECT month, sum(cents) OVER (ORDER BY month) AS running FROM months)""" + _RUNNING_OUT,
    "running_month_totals": _RUNNING + """
SELECT month, cents / 100.0::DOUBLE AS month_sum, sum(cents) OVER (ORDER BY month) / 100.0::DOUBLE AS running_sum FROM months""",
    "months_with_sales": """
SELECT DISTINCT CAST(month(o_orderdate) AS INTEGER) AS month_number FROM orders JOIN lineitem ON l_orderkey = o_orderkey
WHERE year(o_orderdate) = 1999""",
    "customer_range_profile": """
SELECT o_custkey AS customer_id, min(CAST(o_orderdate AS DATE)) AS first_date, max(CAST(o_orderdate AS DATE)) AS last_date,
       count(*) AS row_count FROM orders GROUP BY o_custkey""",
    "order_and_line_counts": f"""
{_BOTH}
SELECT status, count(DISTINCT h.order_id) AS order_count, count(DISTINCT l.order_id) AS with_lines, count(l.order_id) AS line_count,
       min(order_date) AS first_date, max(order_date) AS last_date, (SELECT max(order_id) FROM heads) AS max_order_id
FROM heads h LEFT JOIN lines l ON l.order_id = h.order_id GROUP BY status""",
    "top2_items_by_month": f"""
{_BOTH}
, sold AS (
  SELECT DISTINCT item_id, CAST(month(order_date) AS INTEGER) AS month_number,
         CAST(sum(quantity) OVER (PARTITION BY item_id, month(order_date)) AS BIGINT) AS pieces
  FROM lines l JOIN heads h ON h.order_id = l.order_id WHERE order_date BETWEEN DATE '1999-01-01' AND DATE '1999-12-31')
, ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY month_number ORDER BY pieces DESC, item_id) AS INTEGER) AS place FROM sold)
SELECT item_id, p_name AS item_name, month_number, pieces, place FROM ranked LEFT JOIN part ON p_partkey = item_id WHERE place <= 2""",
    "item_functions": """
SELECT p_partkey AS item_id, p_name AS item_name, p_brand AS brand, p_retailprice AS price,
       CAST(dense_rank() OVER (PARTITION BY left(p_name, 1) ORDER BY p_name) AS INTEGER) AS name_rank,
       count(*) OVER (ORDER BY p_partkey) AS running_count, count(*) OVER () AS total_count,
       count(*) OVER (PARTITION BY left(p_name, 1)) AS letter_count,
       lead(p_partkey) OVER (ORDER BY p_name, p_partkey) AS next_item_id,
       lag(p_partkey) OVER (ORDER BY p_name, p_partkey) AS previous_item_id,
       lead(p_name, 1, 'No items') OVER (ORDER BY p_name, p_partkey) AS next_item_name,
       lag(p_name, 2, 'No items') OVER (ORDER BY p_name, p_partkey) AS item_name_two_back,
       CAST(ntile(30) OVER (ORDER BY p_size, p_partkey) AS INTEGER) AS weight_group
FROM part""",
    "last_customer_by_seller": f"""
{_BOTH}
, ranked AS (
  SELECT supplier_id, customer_id, order_date, sum(amount_cents) OVER (PARTITION BY l.order_id) AS cents,
         dense_rank() OVER (PARTITION BY supplier_id ORDER BY order_date DESC) AS r
  FROM lines l JOIN heads h ON h.order_id = l.order_id)
SELECT supplier_id AS seller_id, s_name AS seller_name, customer_id, c_name AS customer_name, order_date,
       cents / 100.0::DOUBLE AS order_sum
FROM ranked LEFT JOIN supplier ON s_suppkey = supplier_id LEFT JOIN customer ON c_custkey = customer_id WHERE r = 1""",
    "top2_purchases_by_customer": f"""
{_PURCHASES}
, ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY customer_id
    ORDER BY unit_cents DESC, order_date DESC, order_id, line_no, item_id, supplier_id) AS INTEGER) AS place FROM bought)
SELECT DISTINCT customer_id, c_name AS customer_name, item_id, p_name AS item_name, unit_cents / 100.0::DOUBLE AS unit_price,
       order_date, place
FROM ranked LEFT JOIN customer ON c_custkey = customer_id LEFT JOIN part ON p_partkey = item_id WHERE place <= 2""",
    "top2_prices_by_customer_apply": f"""
{_PURCHASES}
, ranked AS (
  SELECT customer_id, item_id, unit_cents, order_date,
         dense_rank() OVER (PARTITION BY customer_id ORDER BY unit_cents DESC) AS price_rank,
         dense_rank() OVER (PARTITION BY customer_id, item_id ORDER BY order_date DESC) AS date_rank
  FROM bought)
SELECT DISTINCT c_custkey AS customer_id, c_name AS customer_name, item_id, p_name AS item_name,
       unit_cents / 100.0::DOUBLE AS top_price, order_date AS last_date
FROM customer JOIN ranked ON customer_id = c_custkey LEFT JOIN part ON p_partkey = item_id
WHERE price_rank IN (1, 2) AND date_rank = 1""",
    "customer_price_ranks": f"""
{_PURCHASES}
SELECT customer_id, order_id, item_id, unit_cents / 100.0::DOUBLE AS unit_price FROM bought
QUALIFY dense_rank() OVER (PARTITION BY customer_id ORDER BY unit_cents DESC) <= 3""",
    "top2_orders_per_customer": f"""
WITH {_HEADS}
SELECT c_custkey AS customer_id, c_name AS customer_name, order_id, total_cents / 100.0::DOUBLE AS order_total
FROM customer JOIN heads ON customer_id = c_custkey
QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY total_cents DESC, order_id) <= 2""",
    "line_tiles": f"""
WITH {_LINES}
SELECT order_id, line_no, item_id, supplier_id,
       CAST(ntile(30) OVER (ORDER BY amount_cents, order_id, line_no, item_id, supplier_id) AS INTEGER) AS amount_group
FROM lines""",
    "order_neighbours": f"""
WITH {_HEADS}
SELECT order_id, order_date, row_number() OVER w AS order_number, lead(order_id) OVER w AS next_order_id,
       lag(order_date, 2) OVER w AS date_two_back
FROM heads WINDOW w AS (ORDER BY order_date, order_id)""",
    "running_order_count": f"""
WITH {_HEADS}
SELECT order_id, order_date, count(*) OVER (ORDER BY order_date) AS running_count,
       sum(total_cents) OVER (ORDER BY order_date) / 100.0::DOUBLE AS running_total
FROM heads""",
    "customer_name_ranks": """
SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS segment,
       CAST(dense_rank() OVER (PARTITION BY c_mktsegment ORDER BY c_name) AS INTEGER) AS name_rank
FROM customer""",
    "line_share_of_order": f"""
WITH {_LINES}
SELECT order_id, line_no, item_id, supplier_id, count(*) OVER (PARTITION BY order_id) AS order_lines,
       sum(amount_cents) OVER (PARTITION BY order_id) / 100.0::DOUBLE AS order_sum
FROM lines""",
    "customer_month_pivot": _segment_pivot(),
    "customer_month_pivot_dynamic": _nation_pivot(),
    "customer_month_long": """
SELECT strftime(date_trunc('month', o_orderdate), '%d.%m.%Y') AS invoice_month, c_name AS customer_name, count(*) AS orders
FROM orders LEFT JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2""",
    "addresses_unpivot": """
WITH places AS (
  SELECT DISTINCT c_name AS customer_name, CASE WHEN c_acctbal >= 0 THEN 'Shop ' || c_custkey END AS a, c_mktsegment AS b,
         n_name AS c, r_name AS d
  FROM orders JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey
  LEFT JOIN region ON r_regionkey = n_regionkey WHERE c_name LIKE 'Customer%')
SELECT customer_name, a AS address_line FROM places WHERE a IS NOT NULL
UNION ALL SELECT customer_name, b FROM places WHERE b IS NOT NULL
UNION ALL SELECT customer_name, c FROM places WHERE c IS NOT NULL
UNION ALL SELECT customer_name, d FROM places WHERE d IS NOT NULL""",
    "codes_unpivot": """
SELECT p_partkey AS item_id, p_name AS item_name, p_brand AS code FROM part
UNION ALL SELECT p_partkey, p_name, CAST(p_size AS VARCHAR) FROM part""",
    "segment_list_by_nation": """
SELECT n_name AS nation_name, string_agg(c_mktsegment, ', ' ORDER BY c_mktsegment) AS segment_list
FROM (SELECT DISTINCT n_name, c_mktsegment FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey) GROUP BY n_name""",
    "customer_list_by_nation": """
SELECT nation_name, (place - 1) // 20 + 1 AS part, string_agg(c_name, ', ' ORDER BY c_name) AS customer_name_list
FROM (SELECT nation_name, c_name, row_number() OVER (PARTITION BY nation_name ORDER BY c_name) AS place
      FROM (SELECT DISTINCT n_name AS nation_name, c_name FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey))
GROUP BY nation_name, part""",
    "order_date_parts": f"""
WITH {_HEADS}
SELECT order_id, strftime(order_date, '%d.%m.%Y') AS date_text, strftime(order_date, '%Y-%m-%d') AS iso_text,
       {_MONTH_RU} AS month_ru, monthname(order_date) AS month_en, CAST(year(order_date) AS INTEGER) AS date_year,
       CAST(quarter(order_date) AS INTEGER) AS quarter, CAST(month(order_date) AS INTEGER) AS date_month,
       CAST((month(order_date) - 1) // 4 + 1 AS INTEGER) AS third, last_day(order_date) AS month_end,
       CAST(date_trunc('month', order_date) AS DATE) AS month_start, CAST(order_date - INTERVAL 1 MONTH AS DATE) AS month_before,
       CAST(date_trunc('month', order_date) AS DATE) AS first_day, order_date AS parsed, CAST(NULL AS DATE) AS not_a_date
FROM heads""",
    "days_to_ship": f"""
{_BOTH}
SELECT CAST(date_diff('day', order_date, ship_date) AS INTEGER) AS days, count(*) AS line_count
FROM lines l JOIN heads h ON h.order_id = l.order_id GROUP BY 1""",
    "item_texts": """
SELECT p_partkey AS item_id, p_partkey || ': ' || p_name || ' (' || p_brand || ')' AS label, p_brand AS inside,
       '' AS nothing_inside, left(p_name, 1) AS letter, p_type AS trimmed_type, CAST(p_size AS VARCHAR) AS weight_text,
       TRY_CAST(p_name AS INTEGER) AS no_number, CASE WHEN p_size > 25 THEN 'heavy' ELSE 'light' END AS weight_class
FROM part""",
    "customer_names_trimmed": """
SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer WHERE c_mktsegment IS NOT NULL AND c_mktsegment <> 'BUILDING'""",
    "insert_marked": _INSERTED + "\nSELECT * FROM inserted",
    "insert_then_count": _INSERTED + """
SELECT count(*) AS rows_after, count(*) FILTER (WHERE c_name LIKE 'Test%') AS marked_rows,
       (SELECT count(*) FROM customer) AS rows_before FROM inserted""",
    "delete_marked": _INSERTED + "\nSELECT * FROM inserted WHERE NOT (c_name LIKE 'Test%1')",
    "update_marked": _INSERTED + """
SELECT c_custkey, CASE WHEN c_name LIKE 'Test%3%' THEN c_name || '+' || c_custkey ELSE c_name END AS c_name,
       c_nationkey, c_acctbal, c_mktsegment FROM inserted""",
    "update_balances": """
SELECT c_custkey, c_name, c_nationkey, coalesce(paid, c_acctbal) AS c_acctbal, c_mktsegment
FROM customer LEFT JOIN (SELECT o_custkey, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100 AS paid
                         FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey""",
    "merge_customers": _INSERTED + """
SELECT * FROM inserted
UNION ALL
SELECT (SELECT max(c_custkey) FROM inserted) + 1, 'Test MERGED record', c_nationkey, c_acctbal, c_mktsegment
FROM inserted WHERE c_name LIKE 'Test%3'""",
    "merge_customers_log": _INSERTED + """
SELECT 'UPDATE' AS action, c_custkey AS old_id, c_name AS old_name, c_custkey AS new_id, c_name AS new_name
FROM inserted WHERE c_name LIKE 'Test%' AND NOT c_name LIKE 'Test%3'
UNION ALL
SELECT 'INSERT', NULL, NULL, (SELECT max(c_custkey) FROM inserted) + 1, 'Test MERGED record'
FROM inserted WHERE c_name LIKE 'Test%3'""",
    "merge_parties": _PARTIES + """
SELECT t.c_custkey, t.c_name, t.c_nationkey, coalesce(s.c_acctbal, t.c_acctbal) AS c_acctbal, t.c_mktsegment
FROM target t LEFT JOIN source s ON s.c_name = t.c_name
UNION ALL SELECT c_custkey, c_name, c_nationkey, c_acctbal, 'NEW' FROM fresh""",
    "merge_parties_log": _PARTIES + """
SELECT 'UPDATE' AS action, count(*) AS changed_rows, max(t.c_custkey) AS max_id,
       CAST(sum(round(s.c_acctbal * 100) - round(t.c_acctbal * 100)) AS BIGINT) AS change_cents
FROM target t JOIN source s ON s.c_name = t.c_name
UNION ALL
SELECT 'INSERT', count(*), max(c_custkey), CAST(sum(round(c_acctbal * 100)) AS BIGINT) FROM fresh""",
    "delimited_roundtrip": "SELECT * FROM customer",
    "delimited_roundtrip_wide": "SELECT * FROM customer",
    "delimited_documents": "SELECT * FROM documents",
    "new_dictionary_day": """
SELECT c_custkey AS customer_id, true AS created_today, DATE '2099-01-01' AS valid_to, false AS is_del FROM customer""",
    "materialized_customers": """
SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)""",
    "xml_shred": _STOCK + "\nSELECT * FROM stock",
    "xml_accepted": _STOCK + "\nSELECT * FROM stock WHERE StockItemID % 7 NOT IN (3, 5)",
    "xml_rejected": _STOCK + "\nSELECT StockItemID FROM stock WHERE StockItemID % 7 IN (3, 5)",
    "xml_roundtrip": _STOCK + "\nSELECT * EXCLUDE (StockItemID) FROM stock",
    "xml_merge": _STOCK_FRESH + """
SELECT * REPLACE (CASE WHEN UnitPackageID >= 20 THEN UnitPrice + 1 ELSE UnitPrice END AS UnitPrice),
       CASE WHEN UnitPackageID >= 20 THEN 1 ELSE 0 END AS LastEditedBy
FROM stock WHERE UnitPackageID <= 40
UNION ALL BY NAME
SELECT * EXCLUDE (new_id) REPLACE (new_id AS StockItemID, UnitPrice + 1 AS UnitPrice), 1 AS LastEditedBy FROM fresh""",
    "xml_merge_log": _STOCK_FRESH + """
SELECT 'UPDATE' AS action, StockItemID AS old_id, StockItemID AS new_id, StockItemName AS item_name,
       UnitPrice AS old_price, UnitPrice + 1 AS new_price
FROM stock WHERE UnitPackageID BETWEEN 20 AND 40
UNION ALL SELECT 'INSERT', NULL, new_id, StockItemName, NULL, UnitPrice + 1 FROM fresh""",
    "json_columns": _TAGS + """
SELECT item_id, item_name, CASE WHEN NOT cut THEN p_brand END AS country,
       CASE WHEN NOT cut AND NOT untagged THEN tag1 END AS first_tag FROM tagged""",
    "json_tag_filter": _TAGS + """
SELECT item_id, item_name, tag1 || ', ' || tag2 || ', ' || p_type AS all_tags FROM tagged
WHERE NOT cut AND NOT untagged AND 'ring' IN (tag1, tag2, p_type)""",
    "json_tag_rows": _TAGS + """
SELECT item_id, 0 AS place, tag1 AS tag FROM tagged WHERE NOT cut AND NOT untagged
UNION ALL SELECT item_id, 1, tag2 FROM tagged WHERE NOT cut AND NOT untagged
UNION ALL SELECT item_id, 2, p_type FROM tagged WHERE NOT cut AND NOT untagged""",
    "event_properties": """
SELECT event_type, CAST(sum(k) AS BIGINT) AS sum_k, max(k) AS max_k, count(k) AS with_k
FROM (SELECT event_type, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events) GROUP BY event_type""",
    "property_list": """
SELECT c_custkey AS customer_id, c_mktsegment AS segment, c_nationkey AS nation_id, CAST(NULL AS VARCHAR) AS absent FROM customer""",
    "customer_with_max_invoice": _BEST + """
SELECT customer_id, c_name AS customer_name, b.order_id, order_date, cents / 100.0::DOUBLE AS invoice_sum
FROM best b JOIN heads h ON h.order_id = b.order_id JOIN customer ON c_custkey = customer_id""",
    "invoices_of_customer": _BEST + """
SELECT customer_id, h.order_id, order_date, sum(amount_cents) / 100.0::DOUBLE AS invoice_sum
FROM lines l JOIN heads h ON h.order_id = l.order_id
WHERE customer_id = (SELECT customer_id FROM heads WHERE order_id = (SELECT order_id FROM best)) GROUP BY ALL""",
    "invoices_of_customers": _INVOICES_OF,
    "invoices_by_function": _INVOICES_OF,
    "best_customer_by_function": _BEST + """
SELECT c_custkey AS customer_id, c_name AS customer_name FROM customer
WHERE c_custkey = (SELECT customer_id FROM heads WHERE order_id = (SELECT order_id FROM best))""",
    "tuned_cross_billing": _BILLING,
    "cross_billing_original": _BILLING,
    "seed_and_validate_finance": f"""
WITH {_CLIENTS}, {_ACCOUNTS}
SELECT CAST(id AS INTEGER) AS id_bal2, name, description, 1 AS id_bal2_parent, DATE '2099-01-01' AS valid_to,
       (SELECT count(*) FROM accounts WHERE id_bal2 = id) AS accounts,
       (SELECT count(*) FILTER (WHERE account_description IS NULL) + count(*) FILTER (WHERE length(account_name) > 20)
             + count(*) FILTER (WHERE length(account_description) > 512) FROM accounts) AS broken_fields,
       (SELECT count(*) FROM accounts WHERE id_client NOT IN (SELECT id_client FROM clients)) AS without_client,
       0::BIGINT AS without_chart, 0::BIGINT AS double_ids, 0::BIGINT AS without_version
FROM (VALUES (1, '*', 'План счетов верхний уровень'), (2, '60', 'Расчёты с поставщиками и подрядчиками'),
  (3, '62', 'Расчеты с покупателями и заказчиками'), (4, '66', 'Расчеты по краткосрочным кредитам и займам'),
  (5, '67', 'Расчеты по долгосрочным кредитам и займам'), (6, '68', 'Расчеты по налогам и сборам'),
  (7, '79', 'Внутрихозяйственные расчеты')) AS chart(id, name, description)""",
    "check_account_fields": f"""
WITH {_ACCOUNTS}
SELECT id_account, 'account_description' AS column_name, 'not null' AS rule FROM accounts WHERE account_description IS NULL
UNION ALL SELECT id_account, 'account_name', 'length <= 4' FROM accounts WHERE length(account_name) > 4
UNION ALL SELECT id_account, 'account_description', 'length <= 22' FROM accounts WHERE length(account_description) > 22""",
    "check_account_clients": f"""
WITH {_CLIENTS}, {_ACCOUNTS}
SELECT id_account, id_client FROM accounts WHERE id_client NOT IN (SELECT id_client FROM clients)""",
    "check_line_keys": """
SELECT l_orderkey AS order_id, l_linenumber AS line_no, count(*) AS row_count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
    "dictionary_upsert": _NEW_CLIENTS + """
SELECT * FROM clients UNION ALL
SELECT id_client, client_name, DATE '2001-01-01', DATE '2099-01-01', false FROM added""",
    "dictionary_upsert_log": _NEW_CLIENTS + "\nSELECT 'INSERT' AS action, id_client, client_name FROM added",
    "insert_reports_seed": f"""
WITH {_CLIENTS}
SELECT * FROM clients UNION ALL
SELECT (SELECT max(id_client) FROM clients) + 1, 'Seed client', DATE '1995-01-01', DATE '2099-01-01', false""",
    "account_upsert": _NEW_CLIENTS + f"""
, {_ACCOUNTS}
, known AS (SELECT id_account, account_name, id_client, id_bal2 FROM accounts WHERE id_client IN (SELECT id_client FROM clients))
, every_client AS (SELECT id_client, client_name FROM clients UNION ALL SELECT id_client, client_name FROM added)
, missing AS (
  SELECT DISTINCT 'A' || c_custkey AS account_name, e.id_client, CASE WHEN c_mktsegment = 'BUILDING' THEN 2 ELSE 3 END AS id_bal2
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN every_client e ON e.client_name = c_name
  WHERE 'A' || c_custkey NOT IN (SELECT account_name FROM known))
SELECT id_account, account_name, id_client, id_bal2, DATE '2099-01-01' AS valid_to FROM known
UNION ALL
SELECT (SELECT max(id_account) FROM known) + row_number() OVER (ORDER BY account_name), account_name, id_client, id_bal2,
       DATE '2099-01-01' FROM missing""",
    "staging_resolve": f"""
WITH {_HEADS}, {_CLIENTS}
, staged AS (SELECT DISTINCT order_date, total_cents, customer_id, status, priority || '/' || c_mktsegment AS agreement_name,
                    c_name, c_nationkey
             FROM heads JOIN customer ON c_custkey = customer_id)
, agreements AS (SELECT agreement_name, row_number() OVER (ORDER BY agreement_name) AS id_agreement
                 FROM (SELECT DISTINCT agreement_name FROM staged WHERE status = 'F'))
SELECT order_date AS carry_date, total_cents / 100.0::DOUBLE AS turnover_sum, c_name AS client_name, status AS carry_ground,
       'nation=' || c_nationkey AS extra_data,
       coalesce((SELECT id_client FROM clients k WHERE k.client_name = c_name AND NOT is_del), -1) AS id_client,
       coalesce(id_agreement, -1) AS id_agreement, customer_id + 1001 AS id_account
FROM staged s LEFT JOIN agreements a ON a.agreement_name = s.agreement_name
WHERE order_date BETWEEN DATE '1998-03-01' AND DATE '1998-03-31'""",
    "posting_reconcile": _RECONCILE + "\nSELECT * FROM emitted",
    "posting_reconcile_again": _RECONCILE + "\nSELECT count(*) AS first_run, 0::BIGINT AS second_run FROM emitted",
    "postings_in_period": """
SELECT o_orderstatus AS carry_ground, count(*) AS postings FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1998-03-01' AND DATE '1998-05-31' GROUP BY 1""",
    "report_requests_stream": _REQUESTS + """
SELECT *, true AS replied FROM counted WHERE customer_id IN (SELECT c_custkey FROM customer)""",
    "report_requests_batches": _REQUESTS + """
SELECT *, true AS replied FROM counted WHERE customer_id IN (SELECT c_custkey FROM customer)""",
    "report_requests_as_written": _REQUESTS + """
SELECT * FROM counted WHERE customer_id IN (SELECT c_custkey FROM customer) AND counter > 0""",
    "report_requests_rejected": _REQUESTS + """
SELECT request_id FROM requests WHERE customer_id NOT IN (SELECT c_custkey FROM customer)""",
    "report_requests_batch": _REQUESTS + "\nSELECT * FROM counted",
    "merge_month": _DELTA + """
SELECT o_orderkey, o_custkey, o_orderstatus, coalesce(cents, CAST(round(o_totalprice * 100) AS BIGINT)) / 100.0::DOUBLE AS o_totalprice,
       CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority
FROM orders LEFT JOIN (SELECT o_orderkey AS k, cents FROM month_orders) ON k = o_orderkey
UNION ALL
SELECT -1 - o_orderkey, o_custkey, o_orderstatus, cents / 100.0::DOUBLE, CAST(o_orderdate AS DATE), o_orderpriority FROM month_orders
WHERE o_orderstatus = 'F'""",
    "merge_month_log": _DELTA + """
SELECT 'UPDATE' AS action, count(*) AS changed_rows, min(o_orderkey) AS lowest_key, CAST(count(*) AS BIGINT) AS change_cents FROM month_orders HAVING count(*) > 0
UNION ALL
SELECT 'INSERT', count(*), -1 - max(o_orderkey), CAST(sum(cents) AS BIGINT) FROM month_orders WHERE o_orderstatus = 'F' HAVING count(*) > 0""",
    "correct_month": """
WITH days AS (SELECT *, CAST(o_orderdate AS DATE) AS day FROM orders)
SELECT o_orderstatus AS status, count(*) AS first_rows, count(*) FILTER (WHERE o_orderpriority IS NULL) AS first_cleared,
       count(*) FILTER (WHERE NOT (day BETWEEN DATE '1997-02-01' AND DATE '1997-02-28' AND o_orderstatus <> 'F')) AS last_rows,
       count(*) FILTER (WHERE o_orderpriority IS NULL OR day BETWEEN DATE '1997-01-01' AND DATE '1997-01-31') AS last_cleared
FROM days GROUP BY 1""",
    "insert_after_delete": """
WITH top AS (SELECT max(c_custkey) AS id FROM customer)
SELECT customer.* FROM customer, top WHERE c_custkey < id
UNION ALL
SELECT id + row_number() OVER (ORDER BY 'Test customer name ' || c_custkey), 'Test customer name ' || c_custkey, c_nationkey, c_acctbal, c_mktsegment
FROM (SELECT * FROM customer ORDER BY c_custkey LIMIT 5), top""",
}
ORACLE["expected_deliveries_by_month"] = ORACLE["expected_deliveries"]
ORACLE["postings_in_period_by_month"] = ORACLE["postings_in_period"]
ORACLE["report_requests_delivered_twice"] = ORACLE["report_requests_compacted"] = _REQUESTS + """
SELECT * FROM counted WHERE customer_id IN (SELECT c_custkey FROM customer)"""
ORACLE["requests_answered"] = _REQUESTS + """
SELECT request_id, customer_id, counter FROM counted
WHERE customer_id IN (SELECT c_custkey FROM customer) AND request_id <= (SELECT floor((min(request_id) + max(request_id)) / 2) FROM requests)"""
ORACLE["requests_still_open"] = _REQUESTS + """
SELECT request_id FROM requests
WHERE customer_id NOT IN (SELECT c_custkey FROM customer) OR request_id > (SELECT floor((min(request_id) + max(request_id)) / 2) FROM requests)"""
