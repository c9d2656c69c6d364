"""Reusable DuckDB SQL fragments for the oracle: flat twins of the change logs.

A flat twin has one column per data column; NULL there means "not
written", '' means "written empty".  They are built from the same tables as
``tidemark.sources.fixtures`` but independently, in plain SQL.
"""

ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
EVENTS_COLS = ["user_id", "event_type", "value", "props"]

_O_KEY = "CAST(o_orderkey AS VARCHAR)"
_O_CUST = "CAST(o_custkey AS VARCHAR)"
_O_PRICE = "CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR)"
_O_DATE = "strftime(o_orderdate, '%Y-%m-%d')"

# Flat twin of the orders change log (k = o_orderkey).
ORDERS_CHG = f"""
orders_chg AS (
  SELECT o_orderkey AS k, 'INSERT' AS op, o_orderkey * 10 AS seq, o_orderdate AS exec_time,
         {_O_KEY} AS o_orderkey, {_O_CUST} AS o_custkey, o_orderstatus, {_O_PRICE} AS o_totalprice,
         {_O_DATE} AS o_orderdate, o_orderpriority
  FROM orders
  UNION ALL
  SELECT o_orderkey, 'UPDATE', o_orderkey * 10 + 1, o_orderdate + INTERVAL 1 DAY,
         {_O_KEY}, {_O_CUST}, 'U', NULL, {_O_DATE}, ''
  FROM orders WHERE o_orderkey % 3 = 0
  UNION ALL
  SELECT o_orderkey, 'DELETE', o_orderkey * 10 + 2, o_orderdate + INTERVAL 2 DAY,
         {_O_KEY}, {_O_CUST}, o_orderstatus, {_O_PRICE}, {_O_DATE}, NULL
  FROM orders WHERE o_orderkey % 7 = 0
  UNION ALL
  SELECT o_orderkey, 'INSERT', o_orderkey * 10 + 3, o_orderdate + INTERVAL 3 DAY,
         {_O_KEY}, {_O_CUST}, 'R', {_O_PRICE}, {_O_DATE}, NULL
  FROM orders WHERE o_orderkey % 21 = 0
)"""

ORDERS_ROW_KEY = "reverse(CAST({k} AS VARCHAR)) || '+shop.orders'"

# Flat twin of the events change log (k = user_id).
EVENTS_CHG = """
events_chg AS (
  SELECT user_id AS k, event_id AS seq, ts AS exec_time, op,
         CAST(user_id AS VARCHAR) AS user_id, event_type,
         CASE WHEN op = 'UPDATE' AND event_id % 5 = 0
              THEN CASE WHEN event_id % 10 = 0 THEN '' END
              ELSE CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) END AS value,
         props
  FROM (SELECT *, CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE' ELSE 'UPDATE' END AS op
        FROM events) e
)"""

EVENTS_ROW_KEY = "reverse(CAST({k} AS VARCHAR)) || '+app.users'"


def closed_form(chg: str, cols: list[str], row_key_sql: str, cond: str = "TRUE", name: str | None = None) -> str:
    """Closed form of apply over a flat twin ``chg`` (columns k, op, seq, cols),
    restricted to change rows satisfying ``cond``; defines CTE ``name``."""
    name = name or f"{chg}_state"
    picks = ",\n  ".join(
        f"max_by(c.{x}, c.seq) FILTER (WHERE c.op <> 'DELETE' AND c.{x} IS NOT NULL AND c.seq > coalesce(d.del_seq, -1)) AS {x}"
        for x in cols
    )
    return f"""
{name}_keys AS (
  SELECT k, max(seq) FILTER (WHERE op = 'DELETE') AS del_seq,
            max(seq) FILTER (WHERE op IN ('INSERT', 'UPDATE')) AS version
  FROM {chg} WHERE {cond} GROUP BY k
),
{name} AS (
  SELECT {row_key_sql.format(k='c.k')} AS row_key, max(d.version) AS version,
  {picks}
  FROM {chg} c JOIN {name}_keys d ON c.k = d.k
  WHERE d.version > coalesce(d.del_seq, -1) AND ({cond.replace('exec_time', 'c.exec_time')})
  GROUP BY c.k
)"""
