"""The fixtures F1-F3 of FIXTURES.md section 3 as SQL over {table} slots, each with its spec."""

from chronofold.spec import HistorySpec

F1 = HistorySpec(keys="id", passthrough="id,name,place,eff_start_date,eff_end_date,active",
                 new_cols="salary,status")
F2 = HistorySpec(keys="customer_id",
                 passthrough="customer_id,segment,valid_from,valid_to,is_current", new_cols="city",
                 start="valid_from", end="valid_to", active="is_current", open_date="9999-12-31")
F3 = HistorySpec(keys="policy_id,product_code",
                 passthrough="policy_id,product_code,coverage_type,eff_start_date,eff_end_date,active",
                 new_cols="premium_amount")

FIXTURES = {
    "f1": (F1, """
SELECT o_custkey AS id, c_name AS name, place, s AS eff_start_date, e AS eff_end_date,
 CASE WHEN e = DATE '3499-12-31' THEN 1 ELSE 0 END AS active, CAST(NULL AS DOUBLE) AS salary, CAST(NULL AS STRING) AS status
 FROM (SELECT o_custkey, place, s, COALESCE(LEAD(s) OVER (PARTITION BY o_custkey ORDER BY s), DATE '3499-12-31') AS e
   FROM (SELECT o_custkey, CAST(o_orderdate AS DATE) AS s, MIN(o_orderpriority) AS place FROM {orders} GROUP BY o_custkey, CAST(o_orderdate AS DATE)) a) b
 JOIN {customer} ON c_custkey = o_custkey""", """
SELECT id, salary, status, s AS eff_start_date, COALESCE(LEAD(s) OVER (PARTITION BY id ORDER BY s), DATE '3499-12-31') AS eff_end_date
 FROM (SELECT o_custkey AS id, CAST(l_shipdate AS DATE) AS s, MIN(l_extendedprice) AS salary, MIN(l_returnflag) AS status
   FROM {orders} JOIN {lineitem} ON l_orderkey = o_orderkey WHERE o_custkey % 3 <> 0 AND l_linenumber = 1
   GROUP BY o_custkey, CAST(l_shipdate AS DATE)) a"""),
    "f2": (F2, """
SELECT user_id AS customer_id, place AS segment, s AS valid_from, e AS valid_to, CASE WHEN e = DATE '9999-12-31' THEN 1 ELSE 0 END AS is_current,
 CAST(NULL AS STRING) AS city
 FROM (SELECT user_id, place, s, COALESCE(LEAD(s) OVER (PARTITION BY user_id ORDER BY s), DATE '9999-12-31') AS e
   FROM (SELECT user_id, CAST(ts AS DATE) AS s, MIN(event_type) AS place FROM {events} WHERE event_type IN ('view','click') GROUP BY user_id, CAST(ts AS DATE)) a) b""", """
SELECT user_id AS customer_id, city, s AS valid_from, COALESCE(LEAD(s) OVER (PARTITION BY user_id ORDER BY s), DATE '2024-01-25') AS valid_to
 FROM (SELECT user_id, CAST(ts AS DATE) AS s, MIN(props) AS city FROM {events} WHERE event_type = 'purchase' AND user_id % 2 = 0 AND ts < TIMESTAMP '2024-01-24 00:00:00' GROUP BY user_id, CAST(ts AS DATE)) a"""),
    "f3": (F3, """
SELECT l_suppkey AS policy_id, l_returnflag AS product_code, coverage AS coverage_type, s AS eff_start_date, e AS eff_end_date,
 CASE WHEN e = DATE '3499-12-31' THEN 1 ELSE 0 END AS active, CAST(NULL AS DOUBLE) AS premium_amount
 FROM (SELECT *, COALESCE(LEAD(s) OVER (PARTITION BY l_suppkey, l_returnflag ORDER BY s), DATE '3499-12-31') AS e
   FROM (SELECT l_suppkey, l_returnflag, CAST(l_shipdate AS DATE) AS s, MIN(l_linestatus) AS coverage FROM {lineitem} WHERE l_linenumber = 1 GROUP BY l_suppkey, l_returnflag, CAST(l_shipdate AS DATE)) a) b""", """
SELECT l_suppkey AS policy_id, l_returnflag AS product_code, premium_amount, s AS eff_start_date, COALESCE(LEAD(s) OVER (PARTITION BY l_suppkey, l_returnflag ORDER BY s), DATE '3499-12-31') AS eff_end_date
 FROM (SELECT l_suppkey, l_returnflag, CAST(l_shipdate AS DATE) AS s, MIN(l_extendedprice) AS premium_amount FROM {lineitem} WHERE l_linenumber = 2 AND l_suppkey % 4 <> 0 GROUP BY l_suppkey, l_returnflag, CAST(l_shipdate AS DATE)) a"""),
}
