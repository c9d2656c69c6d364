"""DuckDB oracle SQL, one text per registered query (same column names)."""

from __future__ import annotations

from tidemark.sources.fixtures import BROKEN
from tidemark.plans.oracle_parts import (
    EVENTS_CHG,
    EVENTS_COLS,
    EVENTS_ROW_KEY,
    ORDERS_CHG,
    ORDERS_COLS,
    ORDERS_ROW_KEY,
    closed_form,
)

ORACLE: dict[str, str] = {}

ORACLE["apply_changes"] = f"""
WITH {ORDERS_CHG},
{closed_form('orders_chg', ORDERS_COLS, ORDERS_ROW_KEY)}
SELECT * FROM orders_chg_state
"""

_ALL_CHG = """
all_chg AS (
  SELECT 'shop.orders' AS source_key, seq, exec_time, op FROM orders_chg
  UNION ALL
  SELECT 'app.users', seq, exec_time, op FROM events_chg
)"""

ORACLE["segment_counts"] = f"""
WITH {ORDERS_CHG}, {EVENTS_CHG}, {_ALL_CHG}
SELECT source_key, strftime(exec_time, '%Y%m%d') AS segment, op, count(*) AS n_events
FROM all_chg GROUP BY ALL
"""

ORACLE["segment_changes"] = f"""
WITH {ORDERS_CHG}, {EVENTS_CHG}, {_ALL_CHG},
l AS (SELECT source_key, seq, exec_time, lag(exec_time) OVER (PARTITION BY source_key ORDER BY seq) AS prev FROM all_chg)
SELECT source_key, seq, strftime(exec_time, '%Y%m%d') AS segment, strftime(prev, '%Y%m%d') AS prev_segment
FROM l
WHERE prev IS NOT NULL AND exec_time > prev AND strftime(exec_time, '%Y%m%d') <> strftime(prev, '%Y%m%d')
"""

_EV_PICKS = ",\n  ".join(f"max_by({c}, seq) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in EVENTS_COLS)

ORACLE["increment_table"] = f"""
WITH {EVENTS_CHG},
inc AS (
  SELECT strftime(exec_time, '%Y%m%d') AS segment, k,
  {_EV_PICKS},
  coalesce(max_by(CASE op WHEN 'INSERT' THEN 'INSERTED' ELSE 'DELETED' END, seq) FILTER (WHERE op IN ('INSERT', 'DELETE')), 'UPDATED') AS final_status
  FROM events_chg GROUP BY ALL
)
SELECT segment, {EVENTS_ROW_KEY.format(k='k')} AS row_key, {', '.join(EVENTS_COLS)}, final_status FROM inc
"""

ORACLE["snapshot_at"] = f"""
WITH {EVENTS_CHG},
{closed_form('events_chg', EVENTS_COLS, EVENTS_ROW_KEY, cond="exec_time < TIMESTAMP '2024-01-15 00:00:00'", name='snap')}
SELECT * FROM snap
"""

ORACLE["segment_ready"] = """
WITH s AS (SELECT strftime(ts, '%Y%m%d') AS segment, event_type AS instance, min(ts) AS ready_at FROM events GROUP BY ALL)
SELECT segment, count(*) AS n_instances, count(*) >= 5 AS ready, max(ready_at) AS ready_at,
       first(instance ORDER BY ready_at, instance) AS elected
FROM s GROUP BY segment
"""

_LI_SUM = """
SELECT reverse(coalesce(l_linestatus, '') || '+' || coalesce(l_returnflag, '')) || '+rollup.lineitem' AS row_key,
       l_linestatus, l_returnflag, sum(CAST(CAST(l_quantity AS VARCHAR) AS DECIMAL(38,18))) AS l_quantity_accumulation
FROM lineitem GROUP BY l_linestatus, l_returnflag
"""
ORACLE["rollup_sum"] = _LI_SUM
ORACLE["rollup_paged"] = _LI_SUM
ORACLE["rollup_sum_decimal"] = """
SELECT reverse(CAST(l_suppkey AS VARCHAR)) || '+rollup.lineitem' AS row_key, l_suppkey,
       sum(CAST(CAST(l_extendedprice AS VARCHAR) AS DECIMAL(38,18))) AS l_extendedprice_accumulation, sum(l_linenumber)::BIGINT AS l_linenumber_accumulation
FROM lineitem GROUP BY l_suppkey
"""

ORACLE["rollup_count"] = """
SELECT reverse(CAST(l_suppkey AS VARCHAR)) || '+count.lineitem' AS row_key, l_suppkey, count(*) AS "count"
FROM lineitem GROUP BY l_suppkey
"""

_ABSENT_INSERTS = f"""
WITH {ORDERS_CHG},
l AS (SELECT *, lag(op) OVER (PARTITION BY k ORDER BY seq) AS prev_op FROM orders_chg),
ins AS (SELECT * FROM l WHERE op = 'INSERT' AND (prev_op IS NULL OR prev_op = 'DELETE'))
"""

ORACLE["rollup_sum_stream"] = _ABSENT_INSERTS + """
SELECT reverse(o_orderstatus) || '+rollup.orders' AS row_key, o_orderstatus,
       sum(CAST(o_totalprice AS DECIMAL(38,18))) AS o_totalprice_accumulation
FROM ins GROUP BY o_orderstatus
"""

ORACLE["rollup_count_stream"] = _ABSENT_INSERTS + """
SELECT reverse(o_orderstatus) || '+count.orders' AS row_key, o_orderstatus, count(*) AS "count"
FROM ins GROUP BY o_orderstatus
"""

# ---- sources, keys and loads -------------------------------------------------

_CLEAN = "'[\\x00-\\x1f]+'"


def _clean(x: str) -> str:
    return f"regexp_replace({x}, {_CLEAN}, ' ', 'g')"


ORACLE["initial_load"] = f"""
SELECT reverse(CAST(p_partkey AS VARCHAR)) || '+shop.part' AS row_key,
       {_clean('CAST(p_partkey AS VARCHAR)')} AS p_partkey, {_clean('p_name')} AS p_name, {_clean('p_brand')} AS p_brand,
       {_clean('p_type')} AS p_type, {_clean('CAST(p_size AS VARCHAR)')} AS p_size
FROM part
"""

ORACLE["paged_scan"] = """
WITH b AS (SELECT coalesce(min(o_orderkey), 0) AS lo, coalesce(max(o_orderkey), 0) AS hi FROM orders),
p AS (SELECT CAST(floor((o_orderkey - lo) / 1000) AS BIGINT) AS page, lo, hi FROM orders, b)
SELECT page, lo + page * 1000 AS page_lo, lo + (page + 1) * 1000 AS page_hi,
       CAST(ceil((hi - lo + 1) / 1000) AS BIGINT) AS n_pages, count(*) AS n_rows
FROM p GROUP BY ALL
"""

ORACLE["paged_scan_signed"] = """
WITH o AS (SELECT CASE WHEN o_orderkey % 11 <> 0 THEN o_orderkey - 5000 END AS k FROM orders),
b AS (SELECT min(k) AS lo, max(k) AS hi FROM o),
p AS (SELECT CAST(floor((k - lo) / 1000) AS BIGINT) AS page, lo, hi FROM o, b)
SELECT page, lo + page * 1000 AS page_lo, lo + (page + 1) * 1000 AS page_hi,
       CAST(ceil((hi - lo + 1) / 1000) AS BIGINT) AS n_pages, count(*) AS n_rows
FROM p GROUP BY ALL
"""

ORACLE["shard_union"] = """
SELECT 'shop_a.customer_' || CAST(c_custkey % 2 AS VARCHAR) AS source_key,
       reverse(CAST(c_custkey AS VARCHAR)) || '+shop_a.customer_' || CAST(c_custkey % 2 AS VARCHAR) AS row_key,
       c_custkey, c_name, c_nationkey, c_mktsegment
FROM customer
UNION ALL
SELECT 'shop_b.supplier', reverse(CAST(s_suppkey AS VARCHAR)) || '+shop_b.supplier', s_suppkey, s_name, s_nationkey, CAST(NULL AS VARCHAR)
FROM supplier
"""

ORACLE["row_keys"] = """
SELECT conv_id, turn, reverse(CAST(conv_id AS VARCHAR) || '+' || CAST(turn AS VARCHAR)) || '+chat.conversations' AS row_key
FROM conversations
"""


def _key_check(name: str, cols: list[str]) -> str:
    ordered = sorted(cols)
    rk = " || '+' || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in ordered)
    any_null = " OR ".join(f"{c} IS NULL" for c in cols)
    return f"""
SELECT '{name}' AS table_name, CAST(sum(n) AS BIGINT) AS n_rows,
       CAST(coalesce(sum(n) FILTER (WHERE {any_null}), 0) AS BIGINT) AS n_null_keys,
       count(*) FILTER (WHERE n > 1) AS n_dup_keys,
       (SELECT count(*) FROM (SELECT reverse({rk}) AS rk FROM (SELECT DISTINCT {', '.join(cols)} FROM {name}) GROUP BY rk HAVING count(*) > 1)) AS n_collisions
FROM (SELECT {', '.join(cols)}, count(*) AS n FROM {name} GROUP BY ALL) g"""


ORACLE["key_check"] = (
    _key_check("lineitem", ["l_orderkey", "l_linenumber"]) + "\nUNION ALL" + _key_check("orders", ["o_orderkey"])
    + "\nUNION ALL" + _key_check("conversations", ["conv_id", "turn"])
)

_MAPPING_VALUES = """
m(source_key, reinitialize) AS (VALUES ('shop.orders', false), ('app.users', true), ('shop_a.customer_0', false),
                                      ('shop_b.supplier', true), ('shop_a.customer_1', false))"""

ORACLE["load_plan"] = f"""
WITH wanted AS (
  SELECT DISTINCT 'shop.orders' AS source_key FROM orders
  UNION SELECT DISTINCT 'app.users' FROM events
  UNION SELECT DISTINCT 'chat.conversations' FROM conversations
  UNION SELECT DISTINCT 'shop_a.customer_' || CAST(c_custkey % 2 AS VARCHAR) FROM customer
  UNION SELECT DISTINCT 'shop_b.supplier' FROM supplier
), {_MAPPING_VALUES}
SELECT w.source_key, CASE WHEN m.source_key IS NULL THEN 'load' WHEN m.reinitialize THEN 'reload' ELSE 'skip' END AS action
FROM wanted w LEFT JOIN m ON w.source_key = m.source_key
"""

ORACLE["decode_changes"] = f"""
WITH {EVENTS_CHG}
SELECT 'app.users' AS source_key, seq * 65536 AS seq, op, {EVENTS_ROW_KEY.format(k='k')} AS row_key, 4 AS n_cells
FROM events_chg
"""

ORACLE["decode_multirow"] = """
WITH e AS (SELECT *, event_id // 8000 AS block FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY event_type, block ORDER BY event_id) - 1 AS pos,
             min(event_id) OVER (PARTITION BY event_type, block) AS first_id, min(ts) OVER (PARTITION BY event_type, block) AS first_ts FROM e)
SELECT 'app.users' AS source_key, (first_id * 8 + list_position(['click', 'error', 'purchase', 'signup', 'view'], event_type)) * 65536 + pos AS seq, 'INSERT' AS op,
       date_trunc('millisecond', first_ts) AS exec_time, CAST(event_id AS VARCHAR) AS event_id, event_type, props
FROM r
"""

_BROKEN = ", ".join("('" + text + "', '" + reason + "')" for text, reason in BROKEN)
ORACLE["decode_rejects"] = f"""
WITH b AS (SELECT row_number() OVER () - 1 AS i, form, reason FROM (VALUES {_BROKEN}) v(form, reason))
SELECT replace(form, '@', CAST(event_id AS VARCHAR)) AS value, reason
FROM events JOIN b ON (event_id // 50) % {len(BROKEN)} = i WHERE event_id % 50 = 7
"""

ORACLE["subscription_filter"] = f"""
WITH {ORDERS_CHG}
SELECT 'shop.orders' AS source_key, op, count(*) AS n_events FROM orders_chg GROUP BY op
UNION ALL SELECT 'chat.conversations', 'INSERT', count(*) FROM conversations
UNION ALL SELECT 'chat.conversations', 'UPDATE', count(*) FROM conversations WHERE role = 'assistant'
"""

_EV_CELLS = "\nUNION ALL\n".join(
    f"SELECT k, seq, '{c}' AS name, {c} AS value FROM events_chg WHERE op <> 'DELETE' AND {c} IS NOT NULL" for c in EVENTS_COLS
)

ORACLE["cells_from_images"] = f"""
WITH {EVENTS_CHG}
SELECT seq, name, value FROM ({_EV_CELLS}) c
"""

ORACLE["clean_values"] = f"""
SELECT doc_id, {_clean('text')} AS text_clean, {_clean('text')} <> text AS changed FROM documents
"""

ORACLE["route_changes"] = f"""
WITH {ORDERS_CHG}, {EVENTS_CHG}
SELECT 'orders_dest' AS destination, 'shop.orders' AS source_key, op, count(*) AS n_events FROM orders_chg GROUP BY op
UNION ALL SELECT 'users_dest', 'app.users', op, count(*) FROM events_chg GROUP BY op
"""

ORACLE["forward_filter"] = f"""
WITH {ORDERS_CHG}, {EVENTS_CHG}
SELECT 'shop.orders' AS source_key, op, count(*) AS n_events FROM orders_chg WHERE exec_time > TIMESTAMP '1996-01-01 00:00:00' GROUP BY op
UNION ALL SELECT 'app.users', op, count(*) FROM events_chg WHERE exec_time > TIMESTAMP '2024-01-10 00:00:00' GROUP BY op
"""

ORACLE["mapping_state"] = """
SELECT 'shop.orders' AS source_key, 'orders_dest' AS destination, min(o_orderdate) AS registered_at FROM orders
UNION ALL SELECT 'app.members', 'users_dest', TIMESTAMP '2024-02-01 00:00:00' FROM (SELECT 1 FROM events LIMIT 1)
UNION ALL SELECT 'shop_a.customer_0', 'party', TIMESTAMP '2024-01-01 00:00:00'
"""

def _substring_index(sep: str) -> str:
    return f"""
SELECT page_id, n, '{sep}' AS sep,
       CASE WHEN n = 0 THEN ''
            WHEN n > 0 THEN array_to_string(string_split(url, '{sep}')[1:n], '{sep}')
            ELSE array_to_string(string_split(url, '{sep}')[n:], '{sep}') END AS part
FROM pages, (VALUES (-3), (-2), (-1), (0), (1), (2), (3)) t(n)"""


ORACLE["substring_index_fn"] = _substring_index("/") + "\nUNION ALL" + _substring_index(".")

# ---- per-change views --------------------------------------------------------


ORACLE["column_audit"] = f"""
WITH c AS (SELECT *, 2 * (conv_id * 1000 + turn) AS s FROM conversations),
a AS (
  SELECT s AS seq, 'INSERT' AS op, 'conv_id' AS column_name, CAST(NULL AS VARCHAR) AS b, CAST(conv_id AS VARCHAR) AS af FROM c
  UNION ALL SELECT s, 'INSERT', 'turn', NULL, CAST(turn AS VARCHAR) FROM c
  UNION ALL SELECT s, 'INSERT', 'role', NULL, role FROM c
  UNION ALL SELECT s, 'INSERT', 'text', NULL, text FROM c
  UNION ALL SELECT s + 1, 'UPDATE', 'text', text, text || ' (edited)' FROM c WHERE role = 'assistant'
)
SELECT 'chat.conversations' AS source_key, seq, op, column_name, b AS before_value, af AS after_value FROM a
"""

ORACLE["cell_versions"] = f"""
WITH {EVENTS_CHG},
keys AS (SELECT k, max(seq) FILTER (WHERE op = 'DELETE') AS del_seq, max(seq) FILTER (WHERE op IN ('INSERT', 'UPDATE')) AS live_seq
         FROM events_chg GROUP BY k),
live AS (SELECT * FROM keys WHERE live_seq > coalesce(del_seq, -1)),
cells AS ({_EV_CELLS}),
r AS (SELECT {EVENTS_ROW_KEY.format(k='c.k')} AS row_key, c.name, c.value, c.seq,
             row_number() OVER (PARTITION BY c.k, c.name ORDER BY c.seq DESC) AS version
      FROM cells c JOIN live l ON c.k = l.k WHERE c.seq > coalesce(l.del_seq, -1))
SELECT row_key, name, version, value, seq FROM r WHERE version <= 2
"""

# ---- schema events on a state ------------------------------------------------

_STATES = f"""
WITH {ORDERS_CHG}, {EVENTS_CHG},
{closed_form('orders_chg', ORDERS_COLS, ORDERS_ROW_KEY)},
{closed_form('events_chg', EVENTS_COLS, EVENTS_ROW_KEY)}
"""


def _n_cells(cols: list[str]) -> str:
    return "CAST(" + " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in cols) + " AS INTEGER)"


ORACLE["source_slice"] = _STATES + "SELECT * FROM events_chg_state"

ORACLE["drop_column"] = _STATES + f"""
SELECT row_key, o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, CAST(NULL AS VARCHAR) AS o_orderpriority,
       {_n_cells(['o_orderkey', 'o_custkey', 'o_orderstatus', 'o_totalprice', 'o_orderdate'])} AS n_cells
FROM orders_chg_state
"""

ORACLE["rename_column"] = _STATES + f"""
SELECT row_key, o_orderkey, o_orderstatus AS o_status, CAST(NULL AS VARCHAR) AS o_orderstatus, {_n_cells(ORDERS_COLS)} AS n_cells
FROM orders_chg_state
"""

ORACLE["rekey"] = _STATES + """
SELECT reverse(coalesce(o_custkey, '') || '+' || coalesce(o_orderkey, '')) || '+shop.orders' AS row_key, o_orderkey, o_custkey
FROM orders_chg_state
"""

ORACLE["rename_source"] = _STATES + """
SELECT 'shop.orders' AS source_key, count(*) AS n_rows, min(row_key) AS min_row_key, max(row_key) AS max_row_key FROM orders_chg_state
UNION ALL
SELECT 'app.members', count(*), min(reverse(user_id) || '+app.members'), max(reverse(user_id) || '+app.members') FROM events_chg_state
"""

ORACLE["stop_source"] = _STATES + """
SELECT 'app.users' AS source_key, (SELECT count(*) FROM events_chg_state) AS n_rows, (SELECT count(*) FROM events_chg) AS n_routed
"""

# ---- monitoring --------------------------------------------------------------

_BATCHES = """
WITH b0 AS (SELECT (min(epoch_us(ts)) // 1000000) // 60 * 60 AS t0, max(epoch_us(ts)) // 1000000 AS hi FROM events),
grid AS (SELECT unnest(range(0, (hi - t0) // 60 + 1)) AS batch_id FROM b0),
per AS (SELECT (epoch_us(ts) // 1000000 - t0) // 60 AS batch_id, count(*) AS n_rows, max(ts) AS last_ts FROM events, b0 GROUP BY 1),
g AS (SELECT grid.batch_id, make_timestamp((t0 + grid.batch_id * 60) * 1000000) AS batch_start,
             make_timestamp((t0 + (grid.batch_id + 1) * 60) * 1000000) AS batch_end,
             coalesce(per.n_rows, 0) AS n_rows, per.last_ts
      FROM grid CROSS JOIN b0 LEFT JOIN per ON grid.batch_id = per.batch_id),
r AS (SELECT *, max(last_ts) OVER (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_exec_time,
                max(CASE WHEN n_rows > 0 THEN batch_id END) OVER (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_busy
      FROM g),
s AS (SELECT *, CASE WHEN n_rows > 0 THEN 0 ELSE batch_id - coalesce(last_busy, -1) END AS idle_pos FROM r),
m AS (SELECT *, idle_pos % 11 AS sleeping_batches FROM s)
"""

ORACLE["progress"] = _BATCHES + "SELECT batch_id, n_rows, last_exec_time, sleeping_batches FROM m"

ORACLE["idle_alerts"] = _BATCHES + "SELECT batch_id, batch_start, idle_pos FROM m WHERE idle_pos > 0 AND sleeping_batches = 0"

ORACLE["lag_alerts"] = _BATCHES + """
SELECT batch_id, batch_end AS check_time, (epoch_us(batch_end) - epoch_us(last_exec_time)) // 1000000 AS delay_seconds,
       hour(batch_end) AS hour, hour(batch_end) NOT IN (0, 1, 2, 3, 4) AS alert
FROM m
WHERE (batch_id + 1) % 15 = 0 AND epoch_us(batch_end) - epoch_us(last_exec_time) >= 1200 * 1000000 AND sleeping_batches = 0
"""

# ---- schema events -----------------------------------------------------------

# What each statement form means, written out by form number (t = p_partkey % 30): nothing here parses a statement.
# Per form: the normalised text, then its clauses as (kind, old name, new name, key list, effect).  tbl, nm and sz
# stand for the table, the name made from the part and its size.
_DDL_FORMS = {
    0: ("'alter table ' || tbl || ' add column ' || nm || ' varchar(64)'", [("add_column", "nm", None, None, "none")]),
    1: ("'alter table ' || tbl || ' drop column ' || nm", [("drop_column", "nm", None, None, "drop_column")]),
    2: ("'alter table ' || tbl || ' change ' || nm || ' ' || nm || '_v2 decimal(10,2) default ''1,5'''", [("change_column", "nm", "nm || '_v2'", None, "rename_column")]),
    3: ("'alter table ' || tbl || ' change column ' || nm || ' ' || nm || ' bigint'", [("noop", "nm", "nm", None, "none")]),
    4: ("'alter table ' || tbl || ' drop primary key, add primary key (id, ' || nm || ')'", [("drop_key", None, None, None, "rekey"), ("add_key", None, None, "'id,' || nm", "rekey")]),
    5: ("'alter table ' || tbl || ' drop primary key'", [("drop_key", None, None, None, "stop")]),
    6: ("'alter table ' || tbl || ' add primary key (id)'", [("add_key", None, None, "'id'", "none")]),
    7: ("'rename table ' || tbl || ' to ' || nm || '_t, ' || nm || '_x to ' || nm || '_y'", [("rename_table", "tbl", "nm || '_t'", None, "rename_source"), ("rename_table", "nm || '_x'", "nm || '_y'", None, "rename_source")]),
    8: ("'alter table ' || tbl || ' rename to ' || nm || '_t'", [("rename_table", "tbl", "nm || '_t'", None, "rename_source")]),
    9: ("'alter table ' || tbl || ' drop foreign key fk_' || sz", [("noop", None, None, None, "none")]),
    10: ("'truncate table ' || tbl", [("truncate", "tbl", None, None, "wipe")]),
    11: ("'alter table ' || tbl || ' auto_increment=' || sz", [("noop", None, None, None, "none")]),
    13: ("'alter table ' || tbl || ' drop partition p' || sz", [("noop", None, None, None, "none")]),
    14: ("'alter table ' || tbl || ' drop constraint ck_' || sz || ', drop check ck_' || nm", [("noop", None, None, None, "none")] * 2),
    15: ("'alter table ' || tbl || ' add column (' || nm || ' decimal(8,3) default \"1,5\", ' || nm || '_b int)'", [("add_column", "nm", None, None, "none"), ("add_column", "nm || '_b'", None, None, "none")]),
    16: ("'alter table ' || tbl || ' add column ' || nm || ' varchar(9) default \"a,b\", drop column ' || nm || '_old'", [("add_column", "nm", None, None, "none"), ("drop_column", "nm || '_old'", None, None, "drop_column")]),
    17: ("'alter table ' || tbl", [("noop", None, None, None, "none")]),
    18: ("'drop table if exists ' || tbl", [("drop_table", "tbl", None, None, "wipe")]),
    19: ("'alter table ' || tbl || ' drop column partition, add partition (partition p' || sz || ' values less than (' || sz || '))'", [("drop_column", "'partition'", None, None, "drop_column"), ("noop", None, None, None, "none")]),
    20: ("'alter table ' || tbl || ' frobnicate ' || nm", [("unknown", None, None, None, "error")]),
    21: ("'create table ' || tbl || ' (id int, primary key (id))'", [("create", "tbl", None, None, "refresh_mapping")]),
    22: ("'alter table if exists ' || tbl || ' drop column if exists ' || nm", [("drop_column", "nm", None, None, "drop_column")]),
    23: ("'alter table ' || tbl || ' drop ' || nm", [("drop_column", "nm", None, None, "drop_column")]),
    24: ("'alter table ' || tbl || ' add column ' || nm || ' text'", [("add_column", "nm", None, None, "none")]),
    25: ("'alter table ' || tbl || ' drop primary key, add primary key using btree (id, ' || nm || '(10) desc)'", [("drop_key", None, None, None, "rekey"), ("add_key", None, None, "'id,' || nm", "rekey")]),
    26: ("'rename table ' || tbl || ' to ' || nm || '_tmp, ' || nm || '_b to ' || tbl || ', ' || nm || '_tmp to ' || nm || '_b'", [("rename_table", "tbl", "nm || '_tmp'", None, "rename_source"), ("rename_table", "nm || '_b'", "tbl", None, "rename_source"), ("rename_table", "nm || '_tmp'", "nm || '_b'", None, "rename_source")]),
    27: ("'alter table ' || tbl || ' add column if not exists ' || nm || ' char(9) default ''a\\'',b'''", [("add_column", "nm", None, None, "none")]),
    28: ("'alter table ' || tbl || ' drop index if exists i_' || sz || ', drop column ' || nm || '_old'", [("noop", None, None, None, "none"), ("drop_column", "nm || '_old'", None, None, "drop_column")]),
    29: ("'alter table ' || tbl || ' change column if exists ' || nm || ' ' || nm || '_v3 int'", [("change_column", "nm", "nm || '_v3'", None, "rename_column")]),
}

_DDL_FIXTURE = """
p AS (
  SELECT p_partkey AS seq, regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g') AS nm,
         'parts_' || regexp_extract(lower(p_brand), '([0-9]+)', 1) AS tbl, CAST(p_size AS VARCHAR) AS sz, p_partkey % 30 AS t
  FROM part),
d AS (SELECT 'shop.' || tbl AS source_key,
             CASE t WHEN 7 THEN 'RENAME' WHEN 26 THEN 'RENAME' WHEN 10 THEN 'TRUNCATE' WHEN 12 THEN 'QUERY' WHEN 18 THEN 'ERASE' WHEN 21 THEN 'CREATE' ELSE 'ALTER' END AS op FROM p)"""

ORACLE["ddl_changelog"] = f"WITH {_DDL_FIXTURE}" + "\nUNION ALL".join(
    f"""
SELECT 'shop.' || tbl AS source_key, seq, CAST({no} AS BIGINT) AS clause_no, '{kind}' AS kind, CAST({old or 'NULL'} AS VARCHAR) AS old_name,
       CAST({new or 'NULL'} AS VARCHAR) AS new_name, CAST({keys or 'NULL'} AS VARCHAR) AS key_list, '{effect}' AS effect FROM p WHERE t = {t}"""
    for t, (_, rows) in _DDL_FORMS.items()
    for no, (kind, old, new, keys, effect) in enumerate(rows, 1)
)

ORACLE["op_summary"] = f"""
WITH {ORDERS_CHG}, {EVENTS_CHG}, {_DDL_FIXTURE},
allops AS (
  SELECT 'shop.orders' AS source_key, op FROM orders_chg
  UNION ALL SELECT 'app.users', op FROM events_chg
  UNION ALL SELECT 'chat.conversations', 'INSERT' FROM conversations
  UNION ALL SELECT 'chat.conversations', 'UPDATE' FROM conversations WHERE role = 'assistant'
  UNION ALL SELECT source_key, op FROM d)
SELECT op, count(*) AS n_events, count(DISTINCT source_key) AS n_sources,
       CASE WHEN op IN ('INSERT', 'UPDATE', 'DELETE') THEN 'row'
            WHEN op IN ('QUERY', 'CINDEX', 'DINDEX') THEN 'ignored'
            WHEN op IN ('ALTER', 'CREATE', 'RENAME', 'TRUNCATE', 'ERASE') THEN 'schema'
            ELSE 'other' END AS op_class
FROM allops GROUP BY op
"""

ORACLE["truncate_source"] = f"""
WITH {ORDERS_CHG},
tr AS (SELECT CAST(floor(max(o_orderkey) / 2) AS BIGINT) * 10 + 5 AS t FROM orders),
orders_chg2 AS (
  SELECT * FROM orders_chg
  UNION ALL
  SELECT DISTINCT k, 'DELETE', t, CAST(NULL AS TIMESTAMP), NULL, NULL, NULL, NULL, NULL, NULL FROM orders_chg, tr
),
{closed_form('orders_chg2', ORDERS_COLS, ORDERS_ROW_KEY)}
SELECT * FROM orders_chg2_state
"""

ORACLE["resolve_groups"] = """
SELECT 'shop.orders' AS source_key, 'orders' AS group_name, 'o_orderkey' AS key_list, 'physical' AS key_origin FROM (SELECT 1 FROM orders LIMIT 1)
UNION ALL SELECT 'app.users', 'users', 'user_id', 'logical' FROM (SELECT 1 FROM events LIMIT 1)
UNION ALL SELECT 'chat.conversations', 'chat', 'conv_id,turn', 'physical' FROM (SELECT 1 FROM conversations LIMIT 1)
UNION ALL SELECT DISTINCT 'shop.parts_' || regexp_extract(lower(p_brand), '([0-9]+)', 1), 'parts', 'id', 'logical' FROM part
"""

# ---- streaming ---------------------------------------------------------------

ORACLE["stream_apply"] = f"""
WITH {EVENTS_CHG},
{closed_form('events_chg', EVENTS_COLS, EVENTS_ROW_KEY)}
SELECT * FROM events_chg_state
"""

ORACLE["schema_notices"] = f"WITH {_DDL_FIXTURE}" + "\nUNION ALL".join(
    f"\nSELECT 'shop.' || tbl AS source_key, seq, {norm} AS ddl FROM p WHERE t = {t}"
    for t, (norm, rows) in _DDL_FORMS.items()
    if all(r[-1] != "error" for r in rows)
)

_T = "(SELECT CAST(floor(max(o_orderkey) {op}) AS BIGINT) * 10 + 5 FROM orders)"
_T1, _T2, _T3 = _T.format(op="/ 3"), _T.format(op="/ 2"), _T.format(op="* 2 / 3")


def _pick(col: str, extra: str = "") -> str:
    return f"max_by(c.{col}, c.seq) FILTER (WHERE c.op <> 'DELETE' AND c.{col} IS NOT NULL AND c.seq > coalesce(d.del_seq, -1){extra})"


ORACLE["apply_schema_events"] = f"""
WITH {ORDERS_CHG},
d AS (SELECT k, max(seq) FILTER (WHERE op = 'DELETE') AS del_seq, max(seq) FILTER (WHERE op IN ('INSERT', 'UPDATE')) AS version
      FROM orders_chg GROUP BY k)
SELECT {ORDERS_ROW_KEY.format(k='c.k')} AS row_key, max(d.version) AS version,
       {_pick('o_orderkey')} AS o_orderkey,
       {_pick('o_custkey')} AS o_custkey,
       {_pick('o_orderstatus', ' AND c.seq > ' + _T1)} AS o_orderstatus,
       CAST(NULL AS VARCHAR) AS o_status,
       {_pick('o_orderstatus', ' AND c.seq < ' + _T1)} AS o_state,
       {_pick('o_totalprice')} AS o_totalprice,
       {_pick('o_orderdate')} AS o_orderdate,
       {_pick('o_orderpriority', ' AND c.seq > ' + _T3)} AS o_orderpriority
FROM orders_chg c JOIN d ON c.k = d.k
WHERE d.version > coalesce(d.del_seq, -1)
GROUP BY c.k
"""

ORACLE["segment_close_stream"] = f"""
WITH {EVENTS_CHG}
SELECT 'app.users' AS source_key, strftime(exec_time, '%Y%m%d') AS segment, op, count(*) AS n_events
FROM events_chg
WHERE date_trunc('day', exec_time) + INTERVAL 1 DAY <= (SELECT max(exec_time) FROM events_chg) - INTERVAL 1 HOUR
GROUP BY ALL
"""

ORACLE["rollup_stream"] = _ABSENT_INSERTS + """
SELECT reverse(o_orderstatus) || '+rollup.orders' AS row_key, o_orderstatus, count(*) AS "count",
       sum(CAST(o_totalprice AS DECIMAL(38,18))) AS o_totalprice_accumulation
FROM ins GROUP BY o_orderstatus
"""

# ---- load, reload, routing and the rest ----------------------------------------

_LOADED = ORDERS_CHG.replace("o_orderkey * 10 AS seq", "0 AS seq")

ORACLE["load_then_apply"] = f"""
WITH {_LOADED},
{closed_form('orders_chg', ORDERS_COLS, ORDERS_ROW_KEY)}
SELECT * FROM orders_chg_state
"""

ORACLE["reload_source"] = f"""
WITH {ORDERS_CHG},
tr AS (SELECT CAST(floor(max(o_orderkey) / 2) AS BIGINT) * 10 + 5 AS t FROM orders),
reloaded AS (
  SELECT * REPLACE (t + 1 AS seq) FROM orders_chg, tr WHERE seq % 10 = 0
  UNION ALL SELECT * FROM orders_chg, tr WHERE seq > t),
{closed_form('reloaded', ORDERS_COLS, ORDERS_ROW_KEY)}
SELECT * FROM reloaded_state
"""

ORACLE["apply_routed"] = f"""
WITH {ORDERS_CHG}, {EVENTS_CHG},
by_customer AS (SELECT * REPLACE (CAST(o_custkey AS BIGINT) AS k) FROM orders_chg),
{closed_form('by_customer', ORDERS_COLS, ORDERS_ROW_KEY)},
{closed_form('events_chg', EVENTS_COLS, EVENTS_ROW_KEY)}
SELECT 'people_dest' AS destination, 'shop.orders' AS source_key, * FROM by_customer_state
UNION ALL BY NAME
SELECT 'people_dest' AS destination, 'app.users' AS source_key, * FROM events_chg_state
"""

ORACLE["range_layout_check"] = """
SELECT count(DISTINCT o_orderkey) AS n_rows, true AS apart, true AS at_most_11, 1 AS n_files, true AS as_stored, '1,1,0' AS found FROM orders
"""

ORACLE["paged_read"] = """
SELECT count(*) AS n_rows, count(*) FILTER (o_orderkey % 11 = 0) AS n_null, 8 AS n_pages, true AS apart, true AS balanced FROM orders
"""

ORACLE["source_keys"] = f"""
WITH {ORDERS_CHG}, {EVENTS_CHG}, {_DDL_FIXTURE},
k AS (SELECT 'shop.orders' AS source_key FROM orders_chg UNION ALL SELECT 'app.users' FROM events_chg UNION ALL SELECT source_key FROM d
      UNION ALL SELECT 'chat.conversations' FROM conversations
      UNION ALL SELECT 'chat.conversations' FROM conversations WHERE role = 'assistant')
SELECT 'db1:3306/' || source_key AS full_key, source_key, count(*) AS n_events FROM k GROUP BY source_key
"""

ORACLE["segment_counts_hourly"] = ORACLE["segment_counts"].replace("'%Y%m%d'", "'%Y%m%d%H'")

ORACLE["reset_signal"] = ORACLE["segment_ready"].rstrip().replace("FROM s GROUP BY segment", "FROM s WHERE segment <> '20240110' GROUP BY segment")

ORACLE["forward_fields"] = f"""
WITH {EVENTS_CHG}
SELECT 'instance_1' AS topic, 'app' AS database, 'users' AS "table", exec_time, op, seq, CASE WHEN op <> 'DELETE' THEN event_type END AS event_type
FROM events_chg WHERE exec_time > TIMESTAMP '2024-01-10 00:00:00'
"""

ORACLE["stream_schema_events"] = ORACLE["apply_schema_events"]
ORACLE["stream_routed"] = ORACLE["apply_routed"]

_AT = "mid AS (SELECT CAST(floor(max(o_orderkey) / 2) AS BIGINT) * 10 + 5 AS t FROM orders)"

ORACLE["apply_rename_source"] = f"""
WITH {ORDERS_CHG},
{closed_form('orders_chg', ORDERS_COLS, "reverse(CAST({k} AS VARCHAR)) || '+shop.orders_new'")}
SELECT 'shop.orders_new' AS source_key, * FROM orders_chg_state
"""

ORACLE["apply_rekey"] = f"""
WITH {ORDERS_CHG}, {_AT},
early AS (SELECT orders_chg.* FROM orders_chg, mid WHERE seq <= t),
{closed_form('early', ORDERS_COLS, ORDERS_ROW_KEY)},
late AS (
  SELECT CAST(o_custkey AS BIGINT) AS k, 'INSERT' AS op, version AS seq, NULL::TIMESTAMP AS exec_time, {', '.join(ORDERS_COLS)} FROM early_state
  UNION ALL
  SELECT CAST(o_custkey AS BIGINT), op, seq, exec_time, {', '.join(ORDERS_COLS)} FROM orders_chg, mid WHERE seq > t),
{closed_form('late', ORDERS_COLS, ORDERS_ROW_KEY)}
SELECT * FROM late_state
"""

ORACLE["apply_stop"] = f"""
WITH {EVENTS_CHG},
{closed_form('events_chg', EVENTS_COLS, EVENTS_ROW_KEY)}
SELECT 'app.users' AS source_key, * FROM events_chg_state
"""

ORACLE["idle_gaps"] = """
WITH l AS (SELECT event_id AS seq, ts AS exec_time, lag(ts) OVER (ORDER BY event_id) AS idle_since FROM events)
SELECT 'app.users' AS source_key, seq, idle_since, exec_time, (epoch_us(exec_time) - epoch_us(idle_since)) // 1000000 AS idle_seconds
FROM l WHERE epoch_us(exec_time) - epoch_us(idle_since) >= 600 * 1000000
"""

ORACLE["increment_stream"] = ORACLE["increment_table"]

ORACLE["stream_rename_source"] = ORACLE["apply_rename_source"]
ORACLE["stream_rekey"] = ORACLE["apply_rekey"]
ORACLE["stream_stop"] = ORACLE["apply_stop"]

# A dropped table keeps nothing from before, as a truncated one.
ORACLE["apply_erase"] = ORACLE["truncate_source"]

_KEYS_OF = ["reverse(o_orderkey)", "reverse(o_custkey)", "reverse(o_custkey || '+' || o_orderdate)", "reverse(o_orderkey)"]


def _generation(g: int, before: str) -> str:
    """The state after generation ``g``: rows carried over, under its keys, and its changes."""
    cols = ", ".join(ORDERS_COLS)
    key = f"{_KEYS_OF[g]} || '+' || src"
    carried = f"""SELECT {key} AS k, 'INSERT' AS op, version AS seq, {cols} FROM (SELECT *, substr(row_key, strpos(row_key, '+shop.') + 1) AS src FROM {before}) UNION ALL""" if before else ""
    return f"""
log{g} AS ({carried} SELECT {key} AS k, op, seq, {cols} FROM dealt WHERE gen = {g}),
{closed_form(f'log{g}', ORDERS_COLS, '{k}', name=f'state{g}')}"""


ORACLE["apply_rekeys"] = f"""
WITH {ORDERS_CHG},
t AS (SELECT max(o_orderkey) AS m FROM orders),
dealt AS (
  SELECT c.*, 'shop.orders_' || lpad(CAST(CAST(o_custkey AS BIGINT) % 20 AS VARCHAR), 2, '0') AS src,
         CAST(seq > floor(m / 4) * 10 + 5 AS INTEGER) + CAST(seq > floor(m * 2 / 4) * 10 + 5 AS INTEGER)
         + CAST(CAST(o_custkey AS BIGINT) % 2 = 0 AND seq > floor(m * 3 / 4) * 10 + 5 AS INTEGER) AS gen
  FROM orders_chg c, t),
{_generation(0, '')},{_generation(1, 'state0')},{_generation(2, 'state1')},
odd AS (SELECT * FROM state2 WHERE CAST(right(row_key, 2) AS INTEGER) % 2 = 1),
even AS (SELECT * FROM state2 WHERE CAST(right(row_key, 2) AS INTEGER) % 2 = 0),{_generation(3, 'even')}
SELECT substr(row_key, strpos(row_key, '+shop.') + 1) AS source_key, * FROM (SELECT * FROM odd UNION ALL SELECT * FROM state3)
"""

ORACLE["apply_swap"] = f"""
WITH {ORDERS_CHG}, {_AT},
dealt AS (SELECT c.* EXCLUDE (k), reverse(c.o_orderkey) || CASE WHEN CAST(c.o_custkey AS BIGINT) % 2 = 0 THEN '+shop.odd' ELSE '+shop.even' END AS k FROM orders_chg c),
{closed_form('dealt', ORDERS_COLS, '{k}')}
SELECT substr(row_key, strpos(row_key, '+') + 1) AS source_key, * FROM dealt_state
"""

ORACLE["stream_snapshots"] = f"""
WITH {EVENTS_CHG},
days AS (SELECT DISTINCT date_trunc('day', exec_time) AS day FROM events_chg),
seen AS (SELECT strftime(day, '%Y%m%d') || '|' || c.k AS k, op, seq, {', '.join(EVENTS_COLS)} FROM events_chg c JOIN days ON exec_time < day),
{closed_form('seen', EVENTS_COLS, "{k}", name='st')}
SELECT split_part(row_key, '|', 1) AS segment, reverse(split_part(row_key, '|', 2)) || '+app.users' AS row_key, version, {', '.join(EVENTS_COLS)} FROM st
"""

# File n of input i holds BARRIER_DAYS[i] days; the watermark after micro-batch n is that of the input least far.
ORACLE["barrier_stream"] = f"""
WITH {EVENTS_CHG},
t AS (SELECT i, days, c.exec_time, c.seq FROM (VALUES (0, 6), (1, 10), (2, 15)) v(i, days) JOIN events_chg c ON c.seq % 3 = i),
lo AS (SELECT i, date_trunc('day', min(exec_time)) AS d0 FROM t GROUP BY i),
f AS (SELECT t.i, dense_rank() OVER (PARTITION BY t.i ORDER BY date_diff('day', d0, exec_time) // days) - 1 AS n, max(exec_time) AS top
      FROM t JOIN lo ON t.i = lo.i GROUP BY t.i, date_diff('day', d0, exec_time) // days),
b AS (SELECT DISTINCT n FROM f),
w AS (SELECT n, min(top) - INTERVAL 1 HOUR AS mark FROM (SELECT b.n, f.i, max(top) AS top FROM b JOIN f ON f.n <= b.n GROUP BY b.n, f.i) GROUP BY n),
s AS (SELECT date_trunc('day', exec_time) AS day, count(DISTINCT i) AS n_inputs, count(*) AS n_events, min_by(i, exec_time) AS elected FROM t GROUP BY 1)
SELECT strftime(day, '%Y%m%d') AS segment, n_inputs, n_events, elected, min(n) + 1 AS closed_in
FROM s JOIN w ON mark >= day + INTERVAL 1 DAY GROUP BY ALL
"""

ORACLE["versions_stream"] = ORACLE["cell_versions"]
ORACLE["feed_rejects"] = ORACLE["decode_rejects"]
# An entry's offset is folded to a place in the order of all rows of all entries.
ORACLE["feed_stream"] = f"SELECT * REPLACE (version * 65536 AS version) FROM ({ORACLE['stream_apply']})"

ORACLE["route_as_of"] = f"""
WITH {ORDERS_CHG}, {EVENTS_CHG}, {_ALL_CHG},
l AS (
  SELECT source_key, exec_time, op FROM all_chg
  UNION ALL SELECT 'chat.conversations', TIMESTAMP '2024-02-01 00:00:00', 'INSERT' FROM conversations WHERE turn < 43200
  UNION ALL SELECT 'chat.conversations', TIMESTAMP '2024-02-02 00:00:00', 'UPDATE' FROM conversations WHERE role = 'assistant'),
m AS (SELECT * FROM (VALUES
  ('shop.orders', 'orders_dest', TIMESTAMP '1992-01-01 00:00:00', TIMESTAMP '1996-01-01 00:00:00', 'shop.orders'),
  ('shop.orders', 'orders_new', TIMESTAMP '1997-06-01 00:00:00', TIMESTAMP '9999-01-01 00:00:00', 'shop.orders'),
  ('app.users', 'users_a', TIMESTAMP '2024-01-05 00:00:00', TIMESTAMP '2024-01-12 00:00:00', 'app.users'),
  ('app.users', 'users_b', TIMESTAMP '2024-01-12 00:00:00', TIMESTAMP '2024-01-20 00:00:00', 'app.users'),
  ('app.users', 'users_a', TIMESTAMP '2024-01-25 12:00:00', TIMESTAMP '9999-01-01 00:00:00', 'app.users'),
  ('chat.conversations', 'chat_dest', TIMESTAMP '2024-02-01 12:00:00', TIMESTAMP '9999-01-01 00:00:00', 'chat.later')) v(source_key, destination, a, b, key_list))
SELECT destination, l.source_key, key_list, op, count(*) AS n_events
FROM l JOIN m ON l.source_key = m.source_key AND exec_time >= a AND exec_time < b GROUP BY ALL
"""

ORACLE["stream_remap"] = f"""
WITH {ORDERS_CHG}, {EVENTS_CHG}, {_AT},
late AS (SELECT CAST(o_custkey AS BIGINT) AS k, op, seq, {', '.join(ORDERS_COLS)} FROM orders_chg, mid WHERE seq > t),
{closed_form('late', ORDERS_COLS, ORDERS_ROW_KEY)},
{closed_form('events_chg', EVENTS_COLS, EVENTS_ROW_KEY)}
SELECT 'shop.orders' AS source_key, *, {', '.join(f'CAST(NULL AS VARCHAR) AS {c}' for c in EVENTS_COLS)} FROM late_state
UNION ALL BY NAME SELECT 'app.users' AS source_key, * FROM events_chg_state
"""

ORACLE["forward_stream"] = f"""
WITH {EVENTS_CHG},
c AS (SELECT *, date_diff('day', (SELECT min(exec_time) FROM events_chg), exec_time) // 6 AS chunk FROM events_chg),
b AS (SELECT chunk, row_number() OVER (ORDER BY chunk) - 1 AS batch FROM (SELECT DISTINCT chunk FROM c))
SELECT 'instance_1' AS topic, batch, op, seq FROM c JOIN b ON c.chunk = b.chunk
WHERE exec_time > TIMESTAMP '2024-01-04 00:00:00' + INTERVAL 1 DAY * (6 * batch)
"""

ORACLE["stream_progress"] = f"""
WITH {ORDERS_CHG}, {EVENTS_CHG},
l AS (SELECT exec_time FROM orders_chg UNION ALL SELECT exec_time FROM events_chg
      UNION ALL SELECT TIMESTAMP '2024-02-01 00:00:00' + INTERVAL 1 SECOND * turn FROM conversations
      UNION ALL SELECT TIMESTAMP '2024-02-02 00:00:00' + INTERVAL 1 SECOND * turn FROM conversations WHERE role = 'assistant'),
y AS (SELECT min(year(exec_time)) AS lo, max(year(exec_time)) AS hi FROM l),
g AS (SELECT unnest(range(hi - lo + 1)) AS batch_id, lo FROM y),
n AS (SELECT g.batch_id, make_timestamp(lo + g.batch_id + 1, 1, 1, 0, 0, 0) AS batch_end, count(exec_time) AS n_rows, max(exec_time) AS last_ts
      FROM g LEFT JOIN l ON year(exec_time) = lo + g.batch_id GROUP BY g.batch_id, lo),
r AS (SELECT *, max(last_ts) OVER w AS last_exec_time, batch_id - coalesce(max(batch_id) FILTER (n_rows > 0) OVER w, -1) AS idle_pos
      FROM n WINDOW w AS (ORDER BY batch_id)),
d AS (SELECT *, idle_pos % 11 AS sleeping_batches, (epoch_us(batch_end) - epoch_us(last_exec_time)) // 1000000 AS delay FROM r)
SELECT batch_id, n_rows, last_exec_time, sleeping_batches, idle_pos > 0 AND sleeping_batches = 0 AS idle_alert,
       CASE WHEN (batch_id + 1) % 3 = 0 AND delay >= 200 * 86400 AND sleeping_batches = 0 THEN delay END AS delay_seconds
FROM d
"""
