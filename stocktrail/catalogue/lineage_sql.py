"""SQL for the run events of the stand-in tables."""

STEPS = """
WITH step AS (
  SELECT 'run-' || o_orderkey AS run_id, 'orders.' || lower(o_orderpriority) AS job,
    'flow-' || o_custkey AS parent, o_orderkey, o_orderdate,
    CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS started_at,
    CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + to_hours(CAST(o_custkey % 72 + 1 AS int)) END AS ended_at
  FROM orders)"""

RUNS = (
    STEPS
    + """, flow AS (
  SELECT 'flow-' || c_custkey AS run_id, 'flow.' || lower(c_mktsegment) AS job,
    TIMESTAMP '1995-01-01' + to_hours(CAST(c_custkey % 24 AS int)) AS started_at,
    TIMESTAMP '2001-12-31' AS ended_at
  FROM customer WHERE c_acctbal >= 0),
run AS (
  SELECT run_id, job, parent, started_at, ended_at FROM step
  UNION ALL SELECT run_id, job, CAST(NULL AS varchar), started_at, ended_at FROM flow)"""
)

TOUCHES = (
    RUNS
    + """, touch AS (
  SELECT DISTINCT l_orderkey, 'read' AS mode, 'raw.' || lower(p_brand) AS name
  FROM lineitem JOIN part ON l_partkey = p_partkey
  UNION SELECT DISTINCT l_orderkey, 'write', 'mart.nation_' || s_nationkey
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
moment AS (
  SELECT run_id, job, o_orderkey, o_orderdate, 'START' AS t, started_at AS m FROM step WHERE started_at IS NOT NULL
  UNION ALL SELECT run_id, job, o_orderkey, o_orderdate, 'COMPLETE', ended_at FROM step WHERE ended_at IS NOT NULL),
touched AS (SELECT * FROM moment JOIN touch ON o_orderkey = l_orderkey)"""
)

EVENTS = (
    TOUCHES
    + """, sizes AS (
  SELECT l_orderkey, count(*) FILTER (mode = 'read') AS n_inputs, count(*) FILTER (mode = 'write') AS n_outputs
  FROM touch GROUP BY 1),
event AS (
  SELECT s.run_id, t AS "eventType", s.job, s.parent, m AS "eventTime",
    coalesce(n_inputs, 0) AS n_inputs, coalesce(n_outputs, 0) AS n_outputs
  FROM moment JOIN step s USING (run_id) LEFT JOIN sizes ON s.o_orderkey = l_orderkey
    CROSS JOIN generate_series(1, 2) g(copy)
  WHERE copy = 1 OR s.job LIKE '%1-urgent'
  UNION ALL SELECT run_id, 'START', job, NULL, started_at, 0, 0 FROM flow
  UNION ALL SELECT run_id, 'COMPLETE', job, NULL, ended_at, 0, 0 FROM flow)"""
)
