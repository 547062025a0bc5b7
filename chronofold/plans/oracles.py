"""Independent SQL for the registered queries, written for DuckDB over the raw tables.

The texts do not follow the way the operators work (no step functions, gaps, salts or segments);
``preserve``, for one, cuts each target row by its own overlaps.
"""

from __future__ import annotations

from dataclasses import dataclass

from chronofold.plans.pairs import NOT_IN_CASES

_OPEN = "DATE '3499-12-31'"


@dataclass(frozen=True)
class _Pair:
    keys: tuple[str, ...]
    carried: tuple[str, ...]
    start: str
    end: str
    active: str
    new: tuple[str, ...]
    high: str
    target: str
    source: str

    @property
    def cols(self) -> tuple[str, ...]:
        return (*self.keys, *self.carried, self.start, self.end, self.active, *self.new)


def _windows(inner: str, keys: str, out: str, start: str, end: str, last: str) -> str:
    """Windows between consecutive days ``d`` of each key of the sub-select ``inner``."""
    return (f"SELECT {out}, d AS {start}, COALESCE(LEAD(d) OVER (PARTITION BY {keys} ORDER BY d), "
            f"{last}) AS {end} FROM ({inner})")


def _flagged(windows: str, end: str, active: str, high: str, nulls: str) -> str:
    return (f"SELECT *, CASE WHEN {end} = {high} THEN 1 ELSE 0 END AS {active}, {nulls} "
            f"FROM ({windows})")


_F1 = _Pair(
    ("id",), ("name", "place"), "eff_start_date", "eff_end_date", "active", ("salary", "status"),
    _OPEN,
    "SELECT w.*, c_name AS name FROM (" + _flagged(
        _windows("SELECT o_custkey AS id, CAST(o_orderdate AS DATE) AS d, "
                 "MIN(o_orderpriority) AS place FROM orders GROUP BY 1, 2",
                 "id", "id, place", "eff_start_date", "eff_end_date", _OPEN),
        "eff_end_date", "active", _OPEN,
        "CAST(NULL AS DOUBLE) AS salary, CAST(NULL AS VARCHAR) AS status")
    + ") w JOIN customer ON c_custkey = id",
    _windows("SELECT o_custkey AS id, CAST(l_shipdate AS DATE) AS d, "
             "MIN(l_extendedprice) AS salary, MIN((l_extendedprice, l_linestatus))[2] AS status "
             "FROM lineitem JOIN orders ON l_orderkey = o_orderkey "
             "WHERE l_returnflag = 'R' GROUP BY 1, 2",
             "id", "id, salary, status", "f", "e", _OPEN),
)

_F2 = _Pair(
    ("customer_id",), ("segment",), "valid_from", "valid_to", "is_current", ("city",),
    "DATE '9999-12-31'",
    _flagged(
        _windows("SELECT user_id AS customer_id, CAST(ts AS DATE) AS d, "
                 "MIN(event_type) AS segment FROM events "
                 "WHERE event_type IN ('view', 'click') GROUP BY 1, 2",
                 "customer_id", "customer_id, segment", "valid_from", "valid_to",
                 "DATE '9999-12-31'"),
        "valid_to", "is_current", "DATE '9999-12-31'", "CAST(NULL AS VARCHAR) AS city"),
    "SELECT customer_id, city, f, LEAST(e, CAST(f + INTERVAL 6 DAY AS DATE)) AS e FROM ("
    + _windows("SELECT user_id AS customer_id, CAST(ts AS DATE) AS d, MIN(props) AS city "
             "FROM events WHERE event_type = 'purchase' GROUP BY 1, 2",
             "customer_id", "customer_id, city", "f", "e", "DATE '9999-12-31'") + ")",
)

_F3 = _Pair(
    ("policy_id", "product_code"), ("coverage_type",), "eff_start_date", "eff_end_date", "active",
    ("premium_amount",), _OPEN,
    _flagged(
        _windows("SELECT l_suppkey AS policy_id, l_returnflag AS product_code, "
                 "CAST(l_shipdate AS DATE) AS d, MIN(l_linestatus) AS coverage_type "
                 "FROM lineitem GROUP BY 1, 2, 3",
                 "policy_id, product_code", "policy_id, product_code, coverage_type",
                 "eff_start_date", "eff_end_date", _OPEN),
        "eff_end_date", "active", _OPEN, "CAST(NULL AS DOUBLE) AS premium_amount"),
    _windows("SELECT l_suppkey AS policy_id, l_returnflag AS product_code, "
             "CAST(o_orderdate AS DATE) AS d, MIN(l_extendedprice) AS premium_amount "
             "FROM lineitem JOIN orders ON l_orderkey = o_orderkey "
             "WHERE o_orderstatus = 'F' GROUP BY 1, 2, 3",
             "policy_id, product_code", "policy_id, product_code, premium_amount", "f", "e",
             _OPEN),
)

_F4 = _Pair(
    ("employee_id",), ("full_name", "department"), "effective_from", "effective_to", "is_active",
    ("grade", "band", "designation"), "DATE '2099-12-31'",
    "SELECT w.*, p_name AS full_name FROM (" + _flagged(
        _windows("SELECT l_partkey AS employee_id, CAST(l_shipdate AS DATE) AS d, "
                 "MIN(l_linestatus) AS department FROM lineitem GROUP BY 1, 2",
                 "employee_id", "employee_id, department", "effective_from", "effective_to",
                 "DATE '2099-12-31'"),
        "effective_to", "is_active", "DATE '2099-12-31'",
        "CAST(NULL AS VARCHAR) AS grade, CAST(NULL AS VARCHAR) AS band, "
        "CAST(NULL AS VARCHAR) AS designation")
    + ") w JOIN part ON p_partkey = employee_id",
    _windows("SELECT l_partkey AS employee_id, CAST(o_orderdate AS DATE) AS d, "
             "MIN(o_orderpriority) AS grade, 'F' AS band, "
             "MIN((o_orderpriority, l_returnflag))[2] AS designation FROM lineitem "
             "JOIN orders ON l_orderkey = o_orderkey "
             "WHERE o_orderstatus = 'F' GROUP BY 1, 2",
             "employee_id", "employee_id, grade, band, designation", "f", "e",
             "DATE '2099-12-31'"),
)

_PAIRS = {"f1": _F1, "f2": _F2, "f3": _F3, "f4": _F4}


def _equal(p: _Pair, a: str, b: str) -> str:
    return " AND ".join(f"{a}.{k} = {b}.{k}" for k in p.keys)


def _ctes(p: _Pair) -> str:
    """t and s are the histories; pairs, left_rows, inner_state, preserved and merged build on
    them. An unused one costs nothing."""
    keys = ", ".join(f"t.{k}" for k in p.keys)
    bare = ", ".join(p.keys)
    carried = "".join(f", t.{c}" for c in p.carried)
    new_s = ", ".join(f"s.{c}" for c in p.new)
    new_t = ", ".join(f"t.{c}" for c in p.new)
    flag = f"CASE WHEN {{}} = {p.high} THEN 1 ELSE 0 END AS {p.active}"
    on = f"{_equal(p, 't', 's')} AND s.f < t.{p.end} AND s.e > t.{p.start}"
    clip = (f"GREATEST(t.{p.start}, s.f) AS {p.start}, LEAST(t.{p.end}, s.e) AS {p.end}, "
            + flag.format(f"LEAST(t.{p.end}, s.e)"))
    same = f"{_equal(p, 'n', 't')} AND n.{p.start} = t.{p.start}"
    changed = " OR ".join(f"n.{c} IS DISTINCT FROM t.{c}" for c in (p.end, *p.new))
    staged_cols = ", ".join(
        f"CASE WHEN t.{p.start} IS NULL OR {changed} THEN n.{c} ELSE t.{c} END AS {c}"
        for c in (p.end, p.active, *p.new))
    carried_staged = "".join(
        f", CASE WHEN t.{p.start} IS NULL THEN n.{c} ELSE t.{c} END AS {c}" for c in p.carried)
    key_staged = ", ".join(f"n.{k}" for k in p.keys)
    plain = ", ".join(p.cols)
    null_new = ", ".join(f"CAST(NULL AS {'DOUBLE' if c in ('salary', 'premium_amount') else 'VARCHAR'})"
                         f" AS {c}" for c in p.new)
    return f"""
WITH t AS ({p.target}),
s AS ({p.source}),
pairs AS (SELECT {keys}{carried}, {clip}, {new_s} FROM t JOIN s ON {on}),
left_rows AS (
  SELECT {keys}{carried},
    CASE WHEN s.f IS NULL THEN t.{p.start} ELSE GREATEST(t.{p.start}, s.f) END AS {p.start},
    CASE WHEN s.f IS NULL THEN t.{p.end} ELSE LEAST(t.{p.end}, s.e) END AS {p.end},
    CASE WHEN LEAST(t.{p.end}, COALESCE(s.e, t.{p.end})) = {p.high} THEN 1 ELSE 0 END AS {p.active},
    {new_s}
  FROM t LEFT JOIN s ON {on}),
uncovered AS (SELECT t.* FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE {_equal(p, 's', 't')})),
inner_state AS (
  SELECT {plain} FROM pairs UNION ALL SELECT {plain} FROM uncovered),
pieces AS (
  SELECT {keys}{carried}, t.{p.start} AS row_start, t.{p.end} AS row_end,
    GREATEST(t.{p.start}, s.f) AS ps, LEAST(t.{p.end}, s.e) AS pe,
    MAX(LEAST(t.{p.end}, s.e)) OVER (PARTITION BY {keys}, t.{p.start}
      ORDER BY GREATEST(t.{p.start}, s.f) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
  FROM t JOIN s ON {on}),
tails AS (
  SELECT {bare}{''.join(f', {c}' for c in p.carried)}, MAX(pe) AS {p.start}, row_end AS {p.end}
  FROM pieces GROUP BY ALL HAVING MAX(pe) < row_end),
bare_rows AS (
  SELECT {keys}{carried}, t.{p.start}, t.{p.end} FROM t
  WHERE EXISTS (SELECT 1 FROM s WHERE {_equal(p, 's', 't')})
    AND NOT EXISTS (SELECT 1 FROM s WHERE {on})),
holes AS (
  SELECT {bare}{''.join(f', {c}' for c in p.carried)},
    COALESCE(before, row_start) AS {p.start}, ps AS {p.end}
  FROM pieces WHERE COALESCE(before, row_start) < ps
  UNION ALL SELECT * FROM tails UNION ALL SELECT * FROM bare_rows),
preserved AS (
  SELECT {plain} FROM inner_state UNION ALL
  SELECT {bare}{''.join(f', {c}' for c in p.carried)}, {p.start}, {p.end},
    {flag.format(p.end)}, {null_new} FROM holes),
merge_kept AS (
  SELECT {key_staged}{carried_staged}, n.{p.start}, {staged_cols}
  FROM left_rows n LEFT JOIN t ON {same}),
stale AS (
  SELECT t.* FROM t WHERE NOT EXISTS (SELECT 1 FROM left_rows n WHERE {same})),
merged AS (
  SELECT {plain} FROM merge_kept UNION ALL SELECT {plain} FROM stale)
"""


def _lagged(p: _Pair, table: str) -> str:
    order = f"PARTITION BY {', '.join(p.keys)} ORDER BY {p.start}, {p.end}"
    return (f"(SELECT *, LAG({p.end}) OVER ({order}) AS prev_end, MAX({p.end}) OVER ({order} "
            f"ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM {table})")


def _gaps(p: _Pair, table: str) -> str:
    return (f"SELECT {', '.join(p.keys)}, prev_end AS gap_from, {p.start} AS gap_to "
            f"FROM {_lagged(p, table)} WHERE prev_end <> {p.start}")


def _overlaps(p: _Pair, table: str, end: str) -> str:
    return (f"SELECT {', '.join(p.keys)}, {end} AS overlap_end, {p.start} AS overlap_start "
            f"FROM {_lagged(p, table)} WHERE {end} > {p.start}")


def _null_count(p: _Pair, table: str) -> str:
    some_null = " OR ".join(f"x.{c} IS NULL" for c in p.new)
    return (f"SELECT COUNT(*) AS unexpected_null_count FROM {table} x WHERE ({some_null}) "
            f"AND EXISTS (SELECT 1 FROM s WHERE {_equal(p, 's', 'x')})")


def _active(p: _Pair, table: str, rule: str) -> str:
    keys = ", ".join(p.keys)
    return (f"SELECT {keys}, CAST(SUM({p.active}) AS BIGINT) AS active_count FROM {table} "
            f"GROUP BY {keys} HAVING SUM({p.active}) {rule}")


def _row_count(table: str) -> str:
    return ("SELECT *, rows_after >= rows_before AS passed FROM (SELECT "
            "(SELECT COUNT(*) FROM t) AS rows_before, "
            f"(SELECT COUNT(*) FROM {table}) AS rows_after)")


def _verdict(p: _Pair, table: str, rule: str) -> str:
    checks = {
        "row_count": "GREATEST((SELECT COUNT(*) FROM t) - (SELECT COUNT(*) FROM "
                     f"{table}), 0)",
        "date_gaps": f"(SELECT COUNT(*) FROM ({_gaps(p, table)}))",
        "date_overlaps": f"(SELECT COUNT(*) FROM ({_overlaps(p, table, 'prev_end')}))",
        "unexpected_nulls": f"({_null_count(p, table)})",
        "active_flags": f"(SELECT COUNT(*) FROM ({_active(p, table, rule)}))",
    }
    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, CAST({n} AS BIGINT) AS findings"
        for name, n in checks.items())
    return f"SELECT *, findings = 0 AS passed FROM ({rows})"


def _days(p: _Pair, table: str) -> str:
    """Time cut at every bound of a key; a piece is covered if some window holds it."""
    keys = ", ".join(p.keys)
    cuts = " UNION ".join(f"SELECT {keys}, {c} AS d FROM {x}" for c in (p.start, p.end) for x in ("t", table))
    inside = f"WHERE {_equal(p, 'x', 'c')} AND x.{p.start} <= c.d AND x.{p.end} >= c.until"
    return f""", cuts AS ({cuts}),
cut_pieces AS (SELECT * FROM (SELECT *, LEAD(d) OVER (PARTITION BY {keys} ORDER BY d) AS until FROM cuts) WHERE until IS NOT NULL),
held AS (SELECT c.*, CAST(c.until - c.d AS BIGINT) AS days, EXISTS (SELECT 1 FROM t x {inside}) AS b,
  EXISTS (SELECT 1 FROM {table} x {inside}) AS a FROM cut_pieces c),
day_counts AS (SELECT {keys}, CAST(SUM(CASE WHEN b THEN days ELSE 0 END) AS BIGINT) AS days_before,
  CAST(SUM(CASE WHEN a THEN days ELSE 0 END) AS BIGINT) AS days_after,
  CAST(SUM(CASE WHEN b AND NOT a THEN days ELSE 0 END) AS BIGINT) AS days_lost FROM held GROUP BY {keys})
SELECT * FROM day_counts"""


def _classified(p: _Pair, compare: tuple[str, ...]) -> str:
    differs = " OR ".join(f"n.{c} IS DISTINCT FROM t.{c}" for c in compare)
    same = f"{_equal(p, 'n', 't')} AND n.{p.start} = t.{p.start}"
    return (f"SELECT n.*, CASE WHEN t.{p.start} IS NULL THEN 'INSERT' WHEN {differs} THEN 'UPDATE' "
            f"ELSE 'SAME' END AS cdc_action FROM left_rows n LEFT JOIN t ON {same}")


def all_oracles() -> dict[str, str]:
    o: dict[str, str] = {}

    def put(name: str, fixture: str, body: str) -> None:
        o[name] = _ctes(_PAIRS[fixture]) + body

    def rows(fixture: str, table: str) -> str:
        return f"SELECT {', '.join(_PAIRS[fixture].cols)} FROM {table}"

    put("target_scan_f1", "f1", rows("f1", "t"))
    put("source_scan_f1", "f1", "SELECT id, salary AS _src_salary, status AS _src_status, "
                                "f AS _src_start, e AS _src_end FROM s")
    put("overlap_pairs_f1", "f1",
        "SELECT t.*, s.salary AS _src_salary, s.status AS _src_status, s.f AS _src_start, "
        "s.e AS _src_end FROM t JOIN s ON t.id = s.id "
        "AND s.f < t.eff_end_date AND s.e > t.eff_start_date")
    for f in _PAIRS:
        put(f"overlap_inner_{f}", f, rows(f, "pairs"))
        put(f"overlap_dyadic_{f}", f, rows(f, "pairs"))
        put(f"overlap_left_{f}", f, rows(f, "left_rows"))
        put(f"backfill_inner_{f}", f, rows(f, "inner_state"))
        put(f"backfill_preserve_{f}", f, rows(f, "preserved"))
        put(f"check_rowcount_{f}", f, _row_count("inner_state"))
        put(f"check_days_{f}", f, _days(_PAIRS[f], "inner_state"))
        put(f"check_verdict_{f}", f, _verdict(_PAIRS[f], "inner_state", "> 1"))
    put("covered_rows_f1", "f1",
        rows("f1", "t") + " WHERE EXISTS (SELECT 1 FROM s WHERE s.id = t.id)")
    put("passthrough_rows_f1", "f1", rows("f1", "uncovered"))
    put("source_gaps_f2", "f2", """
, w AS (SELECT customer_id, f, e, MAX(e) OVER (PARTITION BY customer_id ORDER BY f
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM s)
SELECT customer_id, before AS _src_start, f AS _src_end FROM w WHERE before IS NULL OR before < f
UNION ALL SELECT customer_id, MAX(e), CAST(NULL AS DATE) FROM s GROUP BY customer_id""")

    for name in ("backfill_sql_f1", "backfill_plain_f1", "backfill_broadcast_f1",
                 "backfill_salted_f1", "hot_keys_inner_f1", "publish_readback_f1",
                 "publish_rollback_f1", "clustered_rewrite_f1", "final_listing_f1",
                 "job_overwrite_inner_f1", "colocated_rewrite_f1", "compacted_files_f1"):
        put(name, "f1", rows("f1", "inner_state"))
    put("insert_overwrite_f3", "f3", rows("f3", "inner_state"))
    put("overwrite_script_f3", "f3", rows("f3", "inner_state"))
    put("job_overwrite_preserve_f3", "f3", rows("f3", "preserved"))
    put("job_merge_f1", "f1", rows("f1", "merge_kept"))
    put("job_refused_f1", "f1", rows("f1", "t"))
    put("hot_keys_inner_f3", "f3", rows("f3", "inner_state"))
    put("backfill_salted_preserve_f3", "f3", rows("f3", "preserved"))
    for f in ("f1", "f3"):
        put(f"hot_keys_left_{f}", f, rows(f, "left_rows"))
        put(f"hot_keys_preserve_{f}", f, rows(f, "preserved"))

    put("dyadic_inner_f1", "f1", rows("f1", "inner_state"))
    put("dyadic_left_f3", "f3", rows("f3", "left_rows"))
    put("dyadic_preserve_f2", "f2", rows("f2", "preserved"))
    put("dyadic_preserve_f3", "f3", rows("f3", "preserved"))

    new = _F1.new
    put("cdc_classify_f1", "f1", _classified(_F1, new))
    put("cdc_classify_strict_f1", "f1", _classified(_F1, (_F1.end, *new)))
    put("cdc_counts_f1", "f1", "SELECT cdc_action, COUNT(*) AS row_count FROM ("
        + _classified(_F1, new) + ") GROUP BY cdc_action")
    put("merge_state_f1", "f1", rows("f1", "merged"))
    put("merge_sql_f1", "f1", rows("f1", "merged"))
    put("merge_sql_backfill_f1", "f1", rows("f1", "merge_kept"))
    put("stale_parents_f1", "f1", rows("f1", "stale"))
    put("delete_stale_f1", "f1", rows("f1", "merge_kept"))
    put("merge_backfill_f1", "f1", rows("f1", "merge_kept"))
    put("duplicate_starts_f3", "f3",
        "SELECT policy_id, eff_start_date, COUNT(*) AS copies FROM t "
        "GROUP BY policy_id, eff_start_date HAVING COUNT(*) > 1")

    for f in ("f1", "f2", "f4"):
        put(f"check_gaps_{f}", f, _gaps(_PAIRS[f], "inner_state"))
    put("check_gaps_merge_f1", "f1", _gaps(_F1, "merged"))
    put("check_overlaps_f1", "f1", _overlaps(_F1, "merged", "prev_end"))
    put("check_overlaps_strict_f1", "f1", _overlaps(_F1, "merged", "reach"))
    put("check_nulls_f2", "f2", _null_count(_F2, "left_rows"))
    put("check_active_multi_f1", "f1", _active(_F1, "merged", "> 1"))
    put("check_active_multi_f3", "f3",
        "SELECT policy_id, CAST(SUM(active) AS BIGINT) AS active_count FROM t "
        "GROUP BY policy_id HAVING SUM(active) > 1")
    put("check_active_exact_f2", "f2", _active(_F2, "inner_state", "<> 1"))
    for name, table in (("check_lost_days_f2", "inner_state"), ("check_lost_days_preserve_f2", "preserved")):
        put(name, "f2", _days(_F2, table) + " WHERE days_lost > 0")
    put("check_verdict_merge_f1", "f1", _verdict(_F1, "merged", "<> 1"))

    for f in ("f1", "f3"):
        keys = ", ".join(_PAIRS[f].keys)
        put(f"preflight_counts_{f}", f,
            "SELECT (SELECT COUNT(*) FROM t) AS target_rows_before, "
            "(SELECT COUNT(*) FROM s) AS source_rows, "
            f"(SELECT COUNT(*) FROM (SELECT DISTINCT {keys} FROM s)) AS source_distinct_ids")
    put("population_summary_f1", "f1",
        "SELECT COUNT(*) AS total_rows_after, "
        "CAST(SUM(CASE WHEN salary IS NOT NULL THEN 1 END) AS BIGINT) AS rows_with_salary, "
        "CAST(SUM(CASE WHEN salary IS NULL THEN 1 END) AS BIGINT) AS rows_without_salary, "
        "COUNT(DISTINCT id) AS distinct_ids FROM inner_state")
    put("key_summary_f1", "f1",
        "SELECT id, COUNT(*) AS history_rows, CAST(SUM(active) AS BIGINT) AS active_rows, "
        "MIN(eff_start_date) AS earliest_start, MAX(eff_end_date) AS latest_end, "
        "COUNT(DISTINCT salary) AS distinct_salary_values, "
        "COUNT(DISTINCT status) AS distinct_status_values FROM inner_state GROUP BY id")
    put("expansion_ratio_f1", "f1",
        "SELECT *, CAST(output_rows AS DOUBLE) / CAST(input_rows AS DOUBLE) AS expansion_ratio "
        "FROM (SELECT (SELECT COUNT(*) FROM t) AS input_rows, "
        "(SELECT COUNT(*) FROM inner_state) AS output_rows)")
    put("partition_overwrite_f1", "f1",
        rows("f1", "t") + " WHERE active = 0 UNION ALL " + rows("f1", "inner_state")
        + " WHERE active = 1")
    put("run_history_f1", "f1", """
, n AS (SELECT (SELECT COUNT(*) FROM inner_state) AS i, (SELECT COUNT(*) FROM left_rows) AS l)
SELECT CAST(1 AS BIGINT) AS commit_no, 'overwrite' AS operation, i AS rows FROM n
UNION ALL SELECT 2, 'merge', l FROM n UNION ALL SELECT 3, 'rollback', NULL
UNION ALL SELECT 4, 'rewrite', i FROM n UNION ALL SELECT 5, 'expire', NULL""")

    orders = ("(SELECT o_orderkey, o_orderstatus, o_orderpriority, o_totalprice, "
              "CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE o_custkey END AS cust, "
              "CASE WHEN o_orderstatus = 'O' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS day FROM orders)")
    for name, others in NOT_IN_CASES.items():
        o[f"not_in_null_aware_{name}"] = (
            f"SELECT * FROM {orders} r WHERE (cust, day) NOT IN "
            f"(SELECT cust, day FROM {orders} WHERE {others})")
    lines = ("(SELECT l_orderkey, l_linenumber, l_returnflag, l_extendedprice, NULLIF(l_suppkey, 1) AS supp, "
             "NULLIF(l_linestatus, 'O') AS status, NULLIF(CAST(l_quantity AS INTEGER), 7) AS quantity "
             "FROM lineitem)")
    o["not_in_null_aware_three"] = (
        f"SELECT * FROM {lines} r WHERE (supp, status, quantity) NOT IN "
        f"(SELECT supp, status, quantity FROM {lines} WHERE l_returnflag = 'R' "
        "AND l_extendedprice < 20000)")
    put("stale_parents_null_aware_f1", "f1", rows("f1", "t")
        + " WHERE (id, eff_start_date) NOT IN (SELECT id, eff_start_date FROM left_rows)")

    feed = """, feed AS (
  SELECT n.id, COALESCE(t.name, n.name) AS name, COALESCE(t.place, n.place) AS place, n.eff_start_date, n.eff_end_date,
    CASE WHEN t.id IS NULL OR n.eff_end_date IS DISTINCT FROM t.eff_end_date OR n.salary IS DISTINCT FROM t.salary
      OR n.status IS DISTINCT FROM t.status THEN n.active ELSE t.active END AS active, n.salary, n.status
  FROM left_rows n LEFT JOIN t ON t.id = n.id AND t.eff_start_date = n.eff_start_date
  WHERE n.place IN ('1-URGENT', '2-HIGH'))
SELECT * FROM feed UNION ALL SELECT id, name, place, eff_start_date, eff_end_date, active, salary, status FROM t
WHERE NOT EXISTS (SELECT 1 FROM feed f WHERE f.id = t.id AND f.eff_start_date = t.eff_start_date)"""
    put("merge_touched_f1", "f1", feed)
    put("merge_touched_moving_f1", "f1", feed)
    put("merge_touched_stale_f1", "f1", feed + " AND t.id NOT IN (SELECT id FROM feed)")

    o["modular_filter_list"] = (
        "SELECT CAST(FLOOR(o_orderkey / 1201) AS BIGINT) AS block, "
        "string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS numbers "
        "FROM (SELECT DISTINCT o_orderkey FROM orders "
        "WHERE o_orderkey % 7 = 0 AND o_orderkey % 5 <> 0) GROUP BY 1")
    o["reverse_text"] = "SELECT c_custkey, reverse(c_name) AS reversed_name FROM customer"
    o["swap_name"] = (
        "SELECT p_partkey, split_part(p_name, ' ', 2) || ' ' || split_part(p_name, ' ', 1) "
        "AS swapped_name, reverse(split_part(p_name, ' ', 1)) || ' ' || "
        "reverse(split_part(p_name, ' ', 2)) AS letters_reversed FROM part")
    o["cubic_measure"] = (
        "SELECT p_partkey, CAST(4 AS DOUBLE) / 3 * pi() * "
        "pow(CAST(p_size AS DOUBLE) / 2, CAST(3 AS DOUBLE)) AS volume FROM part")
    return o
