"""The same results as :mod:`registry`, as SQL over the raw tables.

Written from the definitions, without the plan rewrites the queries use:
purchase ranks are a window over the lines, distinct products a distinct count.
"""

from __future__ import annotations

from . import schema

BASE = """
WITH b AS (
  SELECT o_orderkey AS order_id, o_custkey AS user_id, CAST(o_orderdate AS DATE) AS d,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn,
         lag(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS pd,
         count(*) OVER (PARTITION BY o_custkey) AS n
  FROM orders),
f_orders AS (
  SELECT order_id, user_id,
         CASE WHEN rn < n THEN 'prior' WHEN user_id % 3 = 0 THEN 'test' ELSE 'train' END AS eval_set,
         CAST(rn AS INT) AS order_number, CAST(dayofweek(d) AS INT) AS order_dow,
         CAST(order_id % 24 AS INT) AS order_hour_of_day,
         CAST(date_diff('day', pd, d) % 31 AS DOUBLE) AS days_since_prior_order
  FROM b),
kinds AS (
  SELECT *, CAST(row_number() OVER (ORDER BY aisle_id, p_type) AS INT) AS product_id
  FROM (SELECT CAST(replace(p_brand, 'Brand#', '') AS INT) AS aisle_id, p_type,
               arg_min(p_name, p_partkey) AS product_name
        FROM part GROUP BY p_brand, p_type) t),
sold AS (
  SELECT l.l_orderkey AS order_id, k.product_id, min(l.l_linenumber) AS ln
  FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
  JOIN kinds k ON k.aisle_id = CAST(replace(p.p_brand, 'Brand#', '') AS INT) AND k.p_type = p.p_type
  GROUP BY l.l_orderkey, k.product_id),
v_line AS (
  SELECT o.user_id, o.order_id, o.order_number, o.eval_set, l.product_id, l.ln
  FROM sold l JOIN f_orders o ON o.order_id = l.order_id),
v_op AS (
  SELECT order_id, product_id,
         CAST(row_number() OVER (PARTITION BY order_id ORDER BY ln, product_id) AS INT) AS add_to_cart_order,
         CAST(CASE WHEN min(order_number) OVER (PARTITION BY user_id, product_id) < order_number
                   THEN 1 ELSE 0 END AS INT) AS reordered,
         eval_set
  FROM v_line),
f_prior AS (SELECT order_id, product_id, add_to_cart_order, reordered FROM v_op WHERE eval_set = 'prior'),
f_train AS (SELECT order_id, product_id, add_to_cart_order, reordered FROM v_op WHERE eval_set = 'train'),
f_aisles AS (SELECT DISTINCT aisle_id, 'Brand#' || aisle_id AS aisle FROM kinds),
f_products AS (
  SELECT product_id, product_name, aisle_id, CAST((aisle_id - 1) // 5 + 1 AS INT) AS department_id FROM kinds),
f_departments AS (
  SELECT DISTINCT department_id,
         'Brand#' || (department_id * 5 - 4) || '-' || (department_id * 5) AS department
  FROM f_products),
f_sample AS (SELECT order_id, 'None' AS products FROM f_orders WHERE eval_set = 'test'),
y AS (SELECT user_id, max(order_number) AS lastn FROM f_orders WHERE eval_set = 'prior' GROUP BY user_id),
z AS (
  SELECT o.user_id, p.product_id, o.order_number, y.lastn,
         row_number() OVER (PARTITION BY o.user_id, p.product_id ORDER BY o.order_number DESC) AS rn
  FROM f_orders o JOIN f_prior p ON o.order_id = p.order_id JOIN y ON y.user_id = o.user_id),
f_streak AS (
  SELECT user_id, product_id,
         CAST(sum(CASE WHEN order_number = lastn - rn + 1 THEN 1 ELSE 0 END) AS INT) AS order_streak
  FROM z GROUP BY user_id, product_id)
"""

FEATURES = """,
pod AS (
  SELECT o.*, p.product_id, p.add_to_cart_order, p.reordered,
         row_number() OVER (PARTITION BY o.user_id, p.product_id ORDER BY o.order_number) AS bt
  FROM f_orders o JOIN f_prior p ON o.order_id = p.order_id),
prd0 AS (
  SELECT product_id, count(user_id) AS _prod_tot_cnts,
         CAST(sum(reordered) AS BIGINT) AS _prod_reorder_tot_cnts,
         CAST(sum(CASE WHEN bt = 1 THEN 1 ELSE 0 END) AS BIGINT) AS _prod_buy_first_time_total_cnt,
         CAST(sum(CASE WHEN bt = 2 THEN 1 ELSE 0 END) AS BIGINT) AS _prod_buy_second_time_total_cnt
  FROM pod GROUP BY product_id),
prd AS (
  SELECT *,
         _prod_buy_second_time_total_cnt / nullif(_prod_buy_first_time_total_cnt, 0) AS _prod_reorder_prob,
         _prod_reorder_tot_cnts / nullif(_prod_tot_cnts, 0) AS _prod_reorder_ratio,
         CAST(1 AS DOUBLE) + _prod_reorder_tot_cnts / nullif(_prod_buy_first_time_total_cnt, 0) AS _prod_reorder_times
  FROM prd0),
usr0 AS (
  SELECT user_id, max(order_number) AS _user_total_orders,
         sum(days_since_prior_order) AS _user_sum_days_since_prior_order,
         avg(days_since_prior_order) AS _user_mean_days_since_prior_order
  FROM f_orders WHERE eval_set = 'prior' GROUP BY user_id),
usr1 AS (
  SELECT user_id, count(product_id) AS _user_total_products,
         count(DISTINCT product_id) AS _user_distinct_products,
         CAST(sum(reordered) AS DOUBLE) / nullif(sum(CASE WHEN order_number > 1 THEN 1 ELSE 0 END), 0) AS _user_reorder_ratio
  FROM pod GROUP BY user_id),
usr AS (
  SELECT a.*, u._user_total_products, u._user_distinct_products, u._user_reorder_ratio,
         u._user_total_products / nullif(a._user_total_orders, 0) AS _user_average_basket,
         o.order_id, o.eval_set, o.days_since_prior_order AS time_since_last_order
  FROM usr0 a JOIN usr1 u ON u.user_id = a.user_id
  JOIN f_orders o ON o.user_id = a.user_id AND o.eval_set <> 'prior'),
pair AS (
  SELECT user_id, product_id, count(order_number) AS _up_order_count,
         min(order_number) AS _up_first_order_number, max(order_number) AS _up_last_order_number,
         avg(add_to_cart_order) AS _up_average_cart_position
  FROM pod GROUP BY user_id, product_id),
lab AS (
  SELECT o.user_id, t.product_id, t.reordered
  FROM f_train t LEFT JOIN f_orders o ON o.order_id = t.order_id),
m0 AS (
  SELECT pair.*, prd.* EXCLUDE (product_id), usr.* EXCLUDE (user_id),
         _up_order_count / nullif(_user_total_orders, 0) AS _up_order_rate,
         _user_total_orders - _up_last_order_number AS _up_order_since_last_order,
         _up_order_count / nullif(_user_total_orders - _up_first_order_number + 1, 0) AS _up_order_rate_since_first_order,
         nullif(lab.reordered, 0) AS reordered,
         CAST(dense_rank() OVER (ORDER BY f.aisle_id) - 1 AS INT) AS aisle_id,
         CAST(dense_rank() OVER (ORDER BY f.department_id) - 1 AS INT) AS department_id,
         s.order_streak
  FROM pair JOIN prd ON prd.product_id = pair.product_id
  JOIN usr ON usr.user_id = pair.user_id
  LEFT JOIN lab ON lab.user_id = pair.user_id AND lab.product_id = pair.product_id
  LEFT JOIN f_products f ON f.product_id = pair.product_id
  LEFT JOIN f_streak s ON s.user_id = pair.user_id AND s.product_id = pair.product_id),
matrix AS (SELECT %s FROM m0)
""" % ", ".join(schema.MATRIX)

LISTS = """,
picked AS (
  SELECT order_id, eval_set, string_agg(CAST(product_id AS VARCHAR), ' ' ORDER BY product_id) AS products
  FROM matrix WHERE _up_order_rate > CAST(0.202 AS DOUBLE) GROUP BY order_id, eval_set),
truth AS (
  SELECT order_id,
         coalesce(string_agg(CAST(product_id AS VARCHAR), ' ' ORDER BY add_to_cart_order)
                  FILTER (WHERE reordered = 1), 'None') AS products
  FROM f_train GROUP BY order_id),
guess AS (
  SELECT m.order_id, m.fold, coalesce(p.products, 'None') AS products
  FROM (SELECT DISTINCT order_id, CAST(user_id % 4 AS INT) AS fold FROM matrix WHERE eval_set = 'train') m
  LEFT JOIN picked p ON p.order_id = m.order_id),
token AS (
  SELECT g.order_id, g.fold, string_split(replace(g.products, 'None', '-1'), ' ') AS p,
         string_split(replace(t.products, 'None', '-1'), ' ') AS t
  FROM guess g JOIN truth t ON t.order_id = g.order_id),
hit AS (SELECT *, len(list_intersect(p, t)) AS hits FROM token),
f1 AS (
  SELECT order_id, fold, p, t, hits,
         CASE WHEN hits > 0 THEN 2 * (hits / len(p)) * (hits / len(t)) / (hits / len(p) + hits / len(t))
              ELSE CAST(0 AS DOUBLE) END AS f1
  FROM hit)
"""

SEGMENTS = """,
aisle_count AS (
  SELECT o.user_id, a.aisle, count(*) AS n
  FROM f_prior p JOIN f_orders o ON o.order_id = p.order_id
  JOIN f_products f ON f.product_id = p.product_id JOIN f_aisles a ON a.aisle_id = f.aisle_id
  GROUP BY o.user_id, a.aisle),
grid AS (
  SELECT u.user_id, a.aisle, coalesce(c.n, 0) AS n
  FROM (SELECT DISTINCT user_id FROM aisle_count) u
  CROSS JOIN (SELECT DISTINCT aisle FROM aisle_count) a
  LEFT JOIN aisle_count c ON c.user_id = u.user_id AND c.aisle = a.aisle),
profile AS (
  SELECT CAST(user_id % 4 AS INT) AS segment, aisle, avg(n) AS mean_count
  FROM grid GROUP BY user_id % 4, aisle),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY segment ORDER BY mean_count DESC, aisle) AS position
  FROM profile)
"""

WIDE = """,
row_values AS (
  SELECT user_id, product_id, CAST(user_id % 4 AS INT) AS fold,
         [1, _up_order_count, _up_first_order_number, _user_total_orders, _prod_tot_cnts, coalesce(reordered, 0)] AS v
  FROM matrix WHERE eval_set = 'train'),
wide_row AS (
  SELECT (user_id, product_id) AS row_id, fold, CAST(unnest(range(6)) AS INT) AS i, CAST(unnest(v) AS DOUBLE) AS v
  FROM row_values)
"""

HABIT = """,
order_mean AS (
  SELECT o.order_id, m.m, m.n, o.user_id, o.eval_set, o.order_number, o.order_dow,
         o.order_hour_of_day, o.days_since_prior_order
  FROM (SELECT order_id, avg(reordered) AS m, count(*) AS n FROM f_prior GROUP BY order_id) m
  RIGHT JOIN (SELECT * FROM f_orders WHERE order_number > 2) o ON o.order_id = m.order_id),
shares AS (
  SELECT user_id, CAST(sum(CASE WHEN m = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_equal,
         sum(CASE WHEN m = 1 THEN 1 ELSE 0 END) / count(*) AS percent_equal
  FROM order_mean WHERE eval_set = 'prior' GROUP BY user_id),
mostly AS (SELECT * FROM shares WHERE percent_equal >= CAST(0.25 AS DOUBLE)),
habit AS (SELECT user_id FROM mostly ORDER BY n_equal DESC, user_id LIMIT 1),
habit_train AS (
  SELECT user_id FROM mostly
  WHERE user_id IN (SELECT user_id FROM f_orders WHERE eval_set = 'train')
  ORDER BY n_equal DESC, user_id LIMIT 1)
"""

SQL: dict[str, str] = {}


def _add(block: str, *parts: str) -> None:
    """Registers ``-- name`` headed SELECTs under the given CTEs."""
    for piece in block.split("\n-- ")[1:]:
        name, body = piece.split("\n", 1)
        SQL[name.strip()] = BASE + "".join(parts) + body.strip()


_MATRIX = ", ".join(schema.MATRIX)
_HOURS_COUNT = ", ".join(
    f"nullif(count(order_number) FILTER (WHERE order_hour_of_day = {h}), 0) AS h{h:02d}"
    for h in range(24)
)
_HOURS_MEAN = ", ".join(
    f"avg(reordered) FILTER (WHERE order_hour_of_day = {h}) AS h{h:02d}" for h in range(24)
)

_add(
    f"""
-- table_profile
SELECT 'orders' AS table_name, count(*) AS n_rows, CAST(7 AS INT) AS n_columns FROM f_orders
UNION ALL SELECT 'prior', count(*), 4 FROM f_prior
UNION ALL SELECT 'train', count(*), 4 FROM f_train
UNION ALL SELECT 'products', count(*), 4 FROM f_products
UNION ALL SELECT 'aisles', count(*), 2 FROM f_aisles
UNION ALL SELECT 'departments', count(*), 2 FROM f_departments
UNION ALL SELECT 'sample_submission', count(*), 2 FROM f_sample
UNION ALL SELECT 'order_streaks', count(*), 3 FROM f_streak
-- table_preview
SELECT * FROM f_orders ORDER BY order_id LIMIT 5
-- first_n_lines
SELECT * FROM f_prior ORDER BY order_id, add_to_cart_order LIMIT 300000
-- orders_per_user
SELECT user_id, count(*) AS n_orders FROM f_orders GROUP BY user_id
-- eval_set_rows
SELECT eval_set, count(*) AS n_orders FROM f_orders GROUP BY eval_set
-- eval_set_users
SELECT eval_set, count(DISTINCT user_id) AS n_users FROM f_orders GROUP BY eval_set
-- max_order_hist
SELECT max_order_number, count(*) AS n_users
FROM (SELECT user_id, max(order_number) AS max_order_number FROM f_orders GROUP BY user_id) t
GROUP BY max_order_number
-- orders_by_dow
SELECT order_dow, count(*) AS n_orders FROM f_orders GROUP BY order_dow
-- orders_by_hour
SELECT order_hour_of_day, count(*) AS n_orders FROM f_orders GROUP BY order_hour_of_day
-- dow_hour_counts
SELECT order_dow, {_HOURS_COUNT} FROM f_orders GROUP BY order_dow
-- days_gap_hist
SELECT days_since_prior_order, count(*) AS n_orders FROM f_orders
WHERE days_since_prior_order IS NOT NULL GROUP BY days_since_prior_order
-- days_gap_hist_all
SELECT days_since_prior_order, count(*) AS n_orders FROM f_orders GROUP BY days_since_prior_order
-- orders_by_number
SELECT order_number, count(*) AS n FROM f_orders WHERE eval_set = 'prior' GROUP BY order_number
-- reorder_rate
SELECT 'prior' AS line_set, sum(reordered) / nullif(count(*), 0) AS reorder_rate FROM f_prior
UNION ALL SELECT 'train', sum(reordered) / nullif(count(*), 0) FROM f_train
-- order_any_reorder
SELECT line_set, reordered, n_orders, n_orders / sum(n_orders) OVER (PARTITION BY line_set) AS proportion
FROM (SELECT line_set, reordered, count(*) AS n_orders
      FROM (SELECT eval_set AS line_set, order_id, CAST(least(sum(reordered), 1) AS INT) AS reordered
            FROM v_op WHERE eval_set IN ('prior', 'train') GROUP BY eval_set, order_id) t
      GROUP BY line_set, reordered) u
-- basket_size_hist
SELECT line_set, n_items, count(*) AS n_orders
FROM (SELECT eval_set AS line_set, order_id, max(add_to_cart_order) AS n_items
      FROM v_op WHERE eval_set IN ('prior', 'train') GROUP BY eval_set, order_id) t
GROUP BY line_set, n_items
-- cart_pos_reorder
SELECT least(add_to_cart_order, 70) AS add_to_cart_order_mod, avg(reordered) AS reordered
FROM f_prior GROUP BY least(add_to_cart_order, 70)
-- dow_reorder
SELECT order_dow, avg(reordered) AS reordered FROM f_train JOIN f_orders USING (order_id) GROUP BY order_dow
-- hour_reorder
SELECT order_hour_of_day, avg(reordered) AS reordered
FROM f_train JOIN f_orders USING (order_id) GROUP BY order_hour_of_day
-- dow_hour_reorder
SELECT order_dow, {_HOURS_MEAN} FROM f_train JOIN f_orders USING (order_id) GROUP BY order_dow
-- gap_reorder
SELECT days_since_prior_order, avg(reordered) AS mean_reorder
FROM f_train LEFT JOIN f_orders USING (order_id) GROUP BY days_since_prior_order
-- reorder_split
SELECT reordered, count(*) AS count, count(*) / sum(count(*)) OVER () AS proportion
FROM f_train GROUP BY reordered
-- top_products
SELECT product_name, count(*) AS frequency_count FROM f_prior p LEFT JOIN f_products f ON f.product_id = p.product_id
WHERE product_name IS NOT NULL GROUP BY product_name ORDER BY frequency_count DESC, product_name LIMIT 20
-- top_products_10
SELECT product_name, count(*) AS frequency_count FROM f_prior p LEFT JOIN f_products f ON f.product_id = p.product_id
WHERE product_name IS NOT NULL GROUP BY product_name ORDER BY frequency_count DESC, product_name LIMIT 10
-- top_aisles
SELECT aisle, count(*) AS frequency_count FROM f_prior p JOIN f_products f ON f.product_id = p.product_id
JOIN f_aisles USING (aisle_id) GROUP BY aisle ORDER BY frequency_count DESC, aisle LIMIT 20
-- top_aisles_10
SELECT aisle, count(*) AS frequency_count FROM f_prior p JOIN f_products f ON f.product_id = p.product_id
JOIN f_aisles USING (aisle_id) GROUP BY aisle ORDER BY frequency_count DESC, aisle LIMIT 10
-- department_share
SELECT department, count(*) AS n_lines, count(*) / sum(count(*)) OVER () * 100 AS percent
FROM f_prior p JOIN f_products f ON f.product_id = p.product_id JOIN f_departments USING (department_id)
GROUP BY department
-- department_reorder
SELECT department, avg(reordered) AS reordered
FROM f_prior p JOIN f_products f ON f.product_id = p.product_id JOIN f_departments USING (department_id)
GROUP BY department
-- aisle_reorder
SELECT f.department_id, a.aisle, avg(reordered) AS reordered
FROM f_prior p JOIN f_products f ON f.product_id = p.product_id JOIN f_aisles a USING (aisle_id)
GROUP BY f.department_id, a.aisle
-- bestsellers
SELECT t.product_id, t.count, f.product_name
FROM (SELECT product_id, count(*) AS count, rank() OVER (ORDER BY count(*) DESC) AS r FROM f_train GROUP BY product_id) t
LEFT JOIN f_products f ON f.product_id = t.product_id WHERE r <= 10
-- popularity_reorder
SELECT product_id, avg(reordered) AS proportion_reordered, count(*) AS n FROM f_train GROUP BY product_id
-- most_reordered
SELECT t.product_id, t.proportion_reordered, t.n, f.product_name, f.aisle_id, f.department_id
FROM (SELECT *, rank() OVER (ORDER BY proportion_reordered DESC) AS r
      FROM (SELECT product_id, avg(reordered) AS proportion_reordered, count(*) AS n
            FROM f_train GROUP BY product_id) s WHERE n > 40) t
LEFT JOIN f_products f ON f.product_id = t.product_id WHERE r <= 10
-- first_in_cart
SELECT t.product_id, t.pct, t.count, f.product_name
FROM (SELECT *, rank() OVER (ORDER BY pct DESC) AS r
      FROM (SELECT product_id, add_to_cart_order, count(*) AS count,
                   count(*) / sum(count(*)) OVER (PARTITION BY product_id) AS pct
            FROM f_train GROUP BY product_id, add_to_cart_order) s
      WHERE add_to_cart_order = 1 AND count > 10) t
LEFT JOIN f_products f ON f.product_id = t.product_id WHERE r <= 10
-- organic_share
SELECT organic, count(*) AS count, count(*) / sum(count(*)) OVER () AS proportion
FROM (SELECT CASE WHEN lower(product_name) LIKE '%red%' THEN 'organic' ELSE 'not organic' END AS organic
      FROM f_train t LEFT JOIN f_products f ON f.product_id = t.product_id) s GROUP BY organic
-- organic_reorder
SELECT organic, avg(reordered) AS mean_reordered
FROM (SELECT reordered, CASE WHEN lower(product_name) LIKE '%red%' THEN 'organic' ELSE 'not organic' END AS organic
      FROM f_train t LEFT JOIN f_products f ON f.product_id = t.product_id) s GROUP BY organic
-- portfolio_products
SELECT department_id, aisle_id, count(*) AS n, department, aisle
FROM f_products LEFT JOIN f_departments USING (department_id) LEFT JOIN f_aisles USING (aisle_id)
GROUP BY department_id, aisle_id, department, aisle
-- portfolio_sales
SELECT s.department_id, s.aisle_id, s.sumcount, p.n, d.department, a.aisle, CAST(1 AS INT) AS onesize
FROM (SELECT department_id, aisle_id, count(*) AS sumcount
      FROM f_train t LEFT JOIN f_products f ON f.product_id = t.product_id GROUP BY department_id, aisle_id) s
LEFT JOIN (SELECT department_id, aisle_id, count(*) AS n FROM f_products GROUP BY department_id, aisle_id) p
  ON p.department_id = s.department_id AND p.aisle_id = s.aisle_id
LEFT JOIN f_departments d ON d.department_id = s.department_id LEFT JOIN f_aisles a ON a.aisle_id = s.aisle_id
-- distinct_counts
SELECT count(DISTINCT product_name) AS n_product_names, count(DISTINCT aisle) AS n_aisles
FROM f_prior p JOIN f_products f ON f.product_id = p.product_id JOIN f_aisles USING (aisle_id)
-- reordered_hist
SELECT CAST(i AS INT) AS bin, lo + (hi - lo) * i / 10 AS lower, lo + (hi - lo) * (i + 1) / 10 AS upper,
       coalesce(c, 0) AS count
FROM range(10) r(i)
CROSS JOIN (SELECT CAST(min(reordered) AS DOUBLE) AS lo, CAST(max(reordered) AS DOUBLE) AS hi FROM f_prior) e
LEFT JOIN (SELECT CAST(least(floor((reordered - lo) / (hi - lo) * 10), 9) AS INT) AS k, count(*) AS c
           FROM f_prior CROSS JOIN (SELECT min(reordered) AS lo, max(reordered) AS hi FROM f_prior) GROUP BY k) h
  ON h.k = r.i
-- group_box_stats
SELECT order_dow, count(days_since_prior_order) AS count, min(days_since_prior_order) AS min,
       quantile_cont(days_since_prior_order, 0.25) AS q1, quantile_cont(days_since_prior_order, 0.5) AS median,
       quantile_cont(days_since_prior_order, 0.75) AS q3, max(days_since_prior_order) AS max,
       avg(days_since_prior_order) AS mean
FROM f_orders WHERE days_since_prior_order IS NOT NULL GROUP BY order_dow
-- group_box_stats_by_mean
SELECT product_id, count(*) AS count, CAST(min(add_to_cart_order) AS DOUBLE) AS min,
       quantile_cont(CAST(add_to_cart_order AS DOUBLE), 0.25) AS q1,
       quantile_cont(CAST(add_to_cart_order AS DOUBLE), 0.5) AS median,
       quantile_cont(CAST(add_to_cart_order AS DOUBLE), 0.75) AS q3,
       CAST(max(add_to_cart_order) AS DOUBLE) AS max, avg(add_to_cart_order) AS mean
FROM f_prior GROUP BY product_id
-- filter_eval_set
SELECT * FROM f_orders WHERE eval_set <> 'prior'
-- prior_detail
SELECT o.*, p.product_id, p.add_to_cart_order, p.reordered FROM f_orders o JOIN f_prior p ON o.order_id = p.order_id
-- order_prior_sorted
SELECT o.*, p.product_id, p.add_to_cart_order, p.reordered FROM f_orders o JOIN f_prior p ON o.order_id = p.order_id
ORDER BY o.user_id, o.order_id
-- train_with_user
SELECT t.*, o.user_id FROM f_train t LEFT JOIN f_orders o ON o.order_id = t.order_id
-- lines_with_dims
SELECT p.*, f.product_name, f.aisle_id, f.department_id, a.aisle, d.department
FROM f_prior p LEFT JOIN f_products f ON f.product_id = p.product_id
LEFT JOIN f_aisles a ON a.aisle_id = f.aisle_id LEFT JOIN f_departments d ON d.department_id = f.department_id
-- lines_with_dims_inner
SELECT p.*, f.product_name, f.aisle_id, f.department_id, a.aisle, d.department
FROM f_prior p JOIN f_products f ON f.product_id = p.product_id
JOIN f_aisles a ON a.aisle_id = f.aisle_id JOIN f_departments d ON d.department_id = f.department_id
-- lines_with_orders
SELECT t.*, o.* EXCLUDE (order_id) FROM f_train t LEFT JOIN f_orders o ON o.order_id = t.order_id
-- eval_set_disjoint
SELECT (SELECT count(*) FROM (SELECT order_id FROM f_prior UNION SELECT order_id FROM f_train
                             UNION SELECT order_id FROM f_sample) u) AS n_orders,
       (SELECT count(*) FROM (SELECT order_id FROM f_prior INTERSECT SELECT order_id FROM f_train) a) AS prior_train,
       (SELECT count(*) FROM (SELECT order_id FROM f_prior INTERSECT SELECT order_id FROM f_sample) b) AS prior_test,
       (SELECT count(*) FROM (SELECT order_id FROM f_train INTERSECT SELECT order_id FROM f_sample) c) AS train_test
-- order_streak
SELECT * FROM f_streak
-- group_stats_multi_joined
SELECT t.*, s.reorder_mean, s.n_lines FROM f_train t
LEFT JOIN (SELECT product_id, avg(reordered) AS reorder_mean, count(reordered) AS n_lines
           FROM f_train GROUP BY product_id) s ON s.product_id = t.product_id
-- group_stats_single
SELECT product_id, count(add_to_cart_order) AS _product_id_count_by_add_to_cart_order,
       CAST(sum(add_to_cart_order) AS BIGINT) AS _product_id_sum_by_add_to_cart_order,
       avg(add_to_cart_order) AS _product_id_mean_by_add_to_cart_order,
       min(add_to_cart_order) AS _product_id_min_by_add_to_cart_order,
       max(add_to_cart_order) AS _product_id_max_by_add_to_cart_order,
       median(add_to_cart_order) AS _product_id_median_by_add_to_cart_order,
       count(DISTINCT add_to_cart_order) AS _product_id_nunique_by_add_to_cart_order
FROM f_prior GROUP BY product_id
-- group_stats_two_keys
SELECT order_dow, order_hour_of_day,
       count(days_since_prior_order) AS _order_doworder_hour_of_day_count_by_days_since_prior_order,
       avg(days_since_prior_order) AS _order_doworder_hour_of_day_mean_by_days_since_prior_order
FROM f_orders GROUP BY order_dow, order_hour_of_day
-- group_stats_joined
SELECT t.*, s.c AS _order_id_count_by_add_to_cart_order, s.m AS _order_id_mean_by_add_to_cart_order
FROM f_train t LEFT JOIN (SELECT order_id, count(add_to_cart_order) AS c, avg(add_to_cart_order) AS m
                          FROM f_train GROUP BY order_id) s ON s.order_id = t.order_id
-- encode_aisle_department
SELECT product_id, CAST(dense_rank() OVER (ORDER BY aisle_id) - 1 AS INT) AS aisle_id,
       CAST(dense_rank() OVER (ORDER BY department_id) - 1 AS INT) AS department_id FROM f_products
-- load_tables
SELECT order_id, user_id, eval_set, order_number,
       CAST(order_dow AS TINYINT) AS order_dow, CAST(order_hour_of_day AS TINYINT) AS order_hour_of_day,
       days_since_prior_order FROM f_orders
-- inferred_csv
SELECT * FROM f_products
"""
)
SQL["load_tables_profile"] = SQL["table_profile"]

_add(
    """
-- orders_reorder_mean
SELECT * FROM order_mean
-- always_reorder_users
SELECT * FROM shares WHERE percent_equal = 1
-- mostly_reorder_users
SELECT * FROM mostly
-- habit_user_lines
SELECT p.*, f.product_name FROM f_prior p LEFT JOIN f_products f ON f.product_id = p.product_id
WHERE p.order_id IN (SELECT order_id FROM order_mean WHERE user_id IN (SELECT user_id FROM habit))
-- orders_of_user
SELECT * FROM f_orders WHERE user_id IN (SELECT user_id FROM habit)
-- train_order_of_user
SELECT * FROM f_orders WHERE eval_set = 'train' AND user_id IN (SELECT user_id FROM habit_train)
-- habit_user_train
SELECT t.*, f.product_name FROM f_train t LEFT JOIN f_products f ON f.product_id = t.product_id
WHERE t.order_id IN (SELECT order_id FROM f_orders
                     WHERE eval_set = 'train' AND user_id IN (SELECT user_id FROM mostly))
""",
    HABIT,
)

_add(
    f"""
-- purchase_ordinal
SELECT user_id, product_id, order_id, order_number, bt AS _user_buy_product_times FROM pod
-- group_stats_multi
SELECT user_id, max(order_number) AS last_order, min(order_number) AS first_order, count(product_id) AS n_lines,
       count(DISTINCT product_id) AS n_products, CAST(sum(reordered) AS BIGINT) AS n_reordered,
       count(*) FILTER (WHERE reordered = 0) AS n_new, avg(add_to_cart_order) AS mean_position,
       median(add_to_cart_order) AS median_position
FROM pod GROUP BY user_id
-- group_stats_own_function
SELECT user_id, count(add_to_cart_order) AS n_lines, max(add_to_cart_order) AS last_place,
       CAST(coalesce(list_sort(list(add_to_cart_order))[-2], max(add_to_cart_order)) AS DOUBLE) AS last_but_one
FROM pod GROUP BY user_id
-- label_join
SELECT pair.user_id, pair.product_id, nullif(lab.reordered, 0) AS reordered
FROM pair LEFT JOIN lab ON lab.user_id = pair.user_id AND lab.product_id = pair.product_id
-- product_features
SELECT * FROM prd
-- user_features
SELECT * FROM usr
-- user_product_features
SELECT * FROM pair
-- feature_matrix
SELECT * FROM matrix
-- train_matrix
SELECT * FROM matrix WHERE eval_set = 'train'
-- test_matrix
SELECT * FROM matrix WHERE eval_set = 'test'
-- dataset_roundtrip
SELECT * FROM matrix WHERE eval_set = 'train'
-- matrix_cache
SELECT * FROM matrix
-- shuffled_train
SELECT * FROM matrix WHERE eval_set = 'train'
-- label_fill
SELECT user_id, product_id, coalesce(reordered, 0) AS reordered FROM matrix WHERE eval_set = 'train'
-- clean_matrix
SELECT user_id, product_id, _user_reorder_ratio, coalesce(reordered, 0) AS reordered
FROM matrix WHERE eval_set = 'train' AND {" AND ".join(f"{f} IS NOT NULL" for f in schema.MODEL_FEATURES)}
-- user_folds
SELECT user_id, product_id, CAST(user_id % 4 AS INT) AS fold FROM matrix WHERE eval_set = 'train'
-- threshold_flags
SELECT user_id, product_id, order_id, CAST(_up_order_rate > CAST(0.202 AS DOUBLE) AS INT) AS flag_202,
       CAST(_up_order_rate > CAST(0.21 AS DOUBLE) AS INT) AS flag_210,
       CAST(_up_order_rate > CAST(0.5 AS DOUBLE) AS INT) AS flag_500 FROM matrix
-- regression_metrics
SELECT round(sqrt(avg((y - p) * (y - p))), 9) AS rmse,
       round(sqrt(avg((ln(y + 1) - ln(p + 1)) * (ln(y + 1) - ln(p + 1)))), 9) AS rmsle,
       round(1 - sum((y - p) * (y - p)) / nullif(var_pop(y) * count(*), 0), 9) AS r2
FROM (SELECT CAST(coalesce(reordered, 0) AS DOUBLE) AS y, _up_order_rate AS p FROM matrix WHERE eval_set = 'train') t
-- binary_metrics
SELECT round(avg(-CASE WHEN y = 1 THEN ln(q) ELSE ln(1 - q) END), 9) AS log_loss,
       round(2 * count(*) FILTER (WHERE p > CAST(0.202 AS DOUBLE) AND y = 1) /
         nullif(count(*) FILTER (WHERE p > CAST(0.202 AS DOUBLE)) + count(*) FILTER (WHERE y = 1), 0), 9) AS f1
FROM (SELECT coalesce(reordered, 0) AS y, _up_order_rate AS p,
             least(greatest(_up_order_rate, CAST(1e-15 AS DOUBLE)), 1 - CAST(1e-15 AS DOUBLE)) AS q
      FROM matrix WHERE eval_set = 'train') t
""",
    FEATURES,
)

_add(
    """
-- predicted_lists
SELECT order_id, products FROM picked
-- submission
SELECT s.order_id, coalesce(p.products, 'None') AS products
FROM f_sample s LEFT JOIN picked p ON p.order_id = s.order_id AND p.eval_set = 'test'
-- submission_csv
SELECT s.order_id, coalesce(p.products, 'None') AS products
FROM f_sample s LEFT JOIN picked p ON p.order_id = s.order_id AND p.eval_set = 'test'
-- submission_scored_csv
SELECT s.order_id, coalesce(p.products, 'None') AS products
FROM f_sample s LEFT JOIN picked p ON p.order_id = s.order_id AND p.eval_set = 'test'
-- complete_test_lists
SELECT m.order_id, coalesce(p.products, 'None') AS products
FROM (SELECT DISTINCT order_id FROM matrix WHERE eval_set = 'test') m LEFT JOIN picked p ON p.order_id = m.order_id
-- ground_truth
SELECT * FROM truth
-- ground_truth_csv
SELECT order_id, products FROM truth
-- order_f1
SELECT order_id, round(f1, 9) AS f1 FROM f1
-- list_overlap
SELECT order_id, CAST(hits AS INT) AS tp, CAST(len(p) - hits AS INT) AS fp, CAST(len(t) - hits AS INT) AS fn,
       round(2 * hits / (2 * hits + len(t) - hits + len(p) - hits), 9) AS f1 FROM f1
-- mean_f1_lists
SELECT round(avg(f1), 9) AS mean_f1 FROM f1
-- mean_f1_sets
SELECT round(avg(2 * hits / (len(p) + len(t))), 9) AS mean_f1 FROM f1
-- cv_folds_union
SELECT fold, order_id, products FROM guess
-- cv_fold_scores
SELECT CAST(fold AS VARCHAR) AS fold, round(avg(f1), 9) AS f1 FROM f1 GROUP BY fold
UNION ALL SELECT 'mean', round(avg(s), 9) FROM (SELECT avg(f1) AS s FROM f1 GROUP BY fold) t
UNION ALL SELECT 'pooled', round(avg(f1), 9) FROM f1
""",
    FEATURES,
    LISTS,
)

_add(
    """
-- user_aisle_counts
SELECT * FROM aisle_count
-- user_aisle_crosstab
SELECT * FROM grid
-- aisle_co_occurrence
SELECT a.aisle AS aisle_i, b.aisle AS aisle_j, sum(CAST(a.n * b.n AS DOUBLE)) AS total
FROM aisle_count a JOIN aisle_count b ON a.user_id = b.user_id AND a.aisle <= b.aisle GROUP BY a.aisle, b.aisle
-- pca_variance
SELECT count(*) AS n_components, round(sum(v), 6) AS total_variance
FROM (SELECT aisle, var_samp(n) AS v FROM grid GROUP BY aisle) t
-- cluster_profile
SELECT * FROM profile
-- cluster_top_aisles
SELECT * FROM ranked WHERE position BETWEEN 1 AND 10
-- cluster_next_aisles
SELECT * FROM ranked WHERE position BETWEEN 11 AND 15
-- cluster_share
SELECT segment, aisle, round(mean_count / sum(mean_count) OVER (PARTITION BY segment) * 100, 9) AS percent
FROM profile WHERE aisle IN (SELECT aisle FROM aisle_count GROUP BY aisle ORDER BY sum(n) DESC, aisle LIMIT 8)
""",
    SEGMENTS,
)

# The integer columns of the matrix and their types.
_INTS = {
    "user_id": "bigint",
    "product_id": "int",
    "_up_order_count": "bigint",
    "_up_first_order_number": "int",
    "_up_last_order_number": "int",
    "_prod_tot_cnts": "bigint",
    "_prod_reorder_tot_cnts": "bigint",
    "_prod_buy_first_time_total_cnt": "bigint",
    "_prod_buy_second_time_total_cnt": "bigint",
    "_user_total_orders": "int",
    "_user_total_products": "bigint",
    "_user_distinct_products": "bigint",
    "order_id": "bigint",
    "_up_order_since_last_order": "int",
    "reordered": "int",
    "aisle_id": "int",
    "department_id": "int",
    "order_streak": "int",
}
_RANGES = "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(min({c}) AS BIGINT) AS min, CAST(max({c}) AS BIGINT) AS max, "
    f"'{t}' AS source FROM matrix"
    for c, t in _INTS.items()
)
_WIDTH = "CASE {} WHEN 'tinyint' THEN 1 WHEN 'smallint' THEN 2 WHEN 'int' THEN 4 ELSE 8 END"
_add(
    f"""
-- narrow_matrix
SELECT {", ".join(_INTS)}, types FROM matrix, (SELECT string_agg("column" || ':' || target, ',' ORDER BY "column") AS types
FROM (SELECT "column", CASE WHEN min < 0 THEN source WHEN max <= 127 THEN 'tinyint' WHEN max <= 32767 THEN 'smallint'
                            WHEN max <= 2147483647 THEN 'int' ELSE 'bigint' END AS target
      FROM ({_RANGES}) r) t) k
-- narrow_ints
SELECT "column", min, max, source, target, CAST({_WIDTH.format("source")} AS INT) AS bytes_before,
       CAST({_WIDTH.format("target")} AS INT) AS bytes_after, min >= 0 AS adjusted
FROM (SELECT *, CASE WHEN min < 0 THEN source WHEN max <= 127 THEN 'tinyint' WHEN max <= 32767 THEN 'smallint'
                     WHEN max <= 2147483647 THEN 'int' ELSE 'bigint' END AS target
      FROM ({_RANGES}) r) t
""",
    FEATURES,
)

_add(
    """
-- split_rows
SELECT user_id, product_id FROM matrix WHERE eval_set = 'train'
  AND CAST('0x' || substr(md5('42|' || user_id || '|' || product_id), 1, 12) AS BIGINT) % 1000000 < 250000
-- product_sums
SELECT a.fold, a.i, b.i AS j, sum(a.v * b.v) AS total
FROM wide_row a JOIN wide_row b ON a.row_id = b.row_id AND a.i <= b.i GROUP BY a.fold, a.i, b.i
-- gbt_score_range
SELECT count(*) AS n_scores, count(DISTINCT (user_id, product_id)) AS n_pairs, CAST(0 AS BIGINT) AS n_outside
FROM matrix WHERE eval_set = 'test'
-- oof_stack_folds
SELECT CAST(CAST('0x' || substr(md5('0|' || user_id || '|' || product_id), 1, 12) AS BIGINT) % 5 AS INT) AS fold,
       count(*) AS n_rows, CAST(0 AS BIGINT) AS n_missing
FROM matrix WHERE eval_set = 'train' GROUP BY fold
""",
    FEATURES + WIDE,
)
_add(
    """
-- sample_rows
SELECT aisle_id, aisle FROM f_aisles ORDER BY md5('42|' || aisle_id || '|' || aisle) LIMIT 5
-- clustered_users
SELECT count(DISTINCT user_id) AS n_users, count(DISTINCT user_id) AS n_distinct, CAST(0 AS BIGINT) AS n_outside
FROM aisle_count
""",
    SEGMENTS,
)
