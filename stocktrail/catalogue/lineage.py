"""Jobs over run events, statements and column lineage."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from stocktrail.catalogue.lineage_sql import RUNS, STEPS, TOUCHES
from stocktrail.catalogue.registry import at, on, query
from stocktrail.functions.scalars import shift
from stocktrail.lineage import events as E, graph as G, runs as R, statements as Q, upkeep as U
from stocktrail.plans import standins as S
from stocktrail.plans.lineage_report import lineage_report
from stocktrail.plans.standins import Tables
from stocktrail.session import cut, scratch_path
from stocktrail.sources import eventlog
from stocktrail.streaming import jobs as J


def _steps(t: Tables) -> DataFrame:
    return E.step_events(S.step_runs(t))


# Making events


@query(
    "L1",
    f"""WITH r AS (SELECT *, CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + INTERVAL 2 MINUTE END AS e FROM orders)
    SELECT 'run-' || o_orderkey AS run_id, 'START' AS "eventType", {at('o_orderdate')} AS "eventTime", o_orderpriority AS job FROM r
    UNION ALL SELECT 'run-' || o_orderkey, 'COMPLETE', {at('e')}, o_orderpriority FROM r WHERE e IS NOT NULL""",
)
def start_and_complete_events(t: Tables) -> DataFrame:
    start = F.col("o_orderdate").cast("timestamp")
    runs = t.orders.select(
        F.concat(F.lit("run-"), F.col("o_orderkey").cast("string")).alias("run_id"),
        F.lit(S.NAMESPACE).alias("namespace"),
        F.col("o_orderpriority").alias("job"),
        start.alias("started_at"),
        F.when(F.col("o_orderstatus") != "O", shift(start, minutes=2)).alias("ended_at"),
    )
    return E.to_events(runs).select(
        F.col("run.runId").alias("run_id"), "eventType", "eventTime", F.col("job.name").alias("job")
    )


def _told(events: DataFrame, *more: Column) -> DataFrame:
    parent = F.col("run.facets.parent")
    return events.select(
        F.col("run.runId").alias("run_id"),
        F.col("job.name").alias("job"),
        parent["run"]["runId"].alias("parent"),
        parent["job"]["name"].alias("parent_job"),
        "eventType",
        "eventTime",
        *more,
    )


@query(
    "L2 X16",
    f"""{STEPS}
    SELECT run_id, job, parent, 'orders' AS parent_job, 'START' AS "eventType", {at('started_at')} AS "eventTime"
    FROM step WHERE started_at IS NOT NULL
    UNION ALL SELECT run_id, job, parent, 'orders', 'COMPLETE', {at('ended_at')} FROM step WHERE ended_at IS NOT NULL""",
)
def events_of_steps(t: Tables) -> DataFrame:
    return _told(_steps(t))


@query(
    "L3 X16",
    f"""SELECT DISTINCT 'sql-' || l_orderkey || '-' || l_returnflag AS run_id,
      'execute_sql.mart.' || lower(l_returnflag) AS job, 'run-' || l_orderkey AS parent,
      'orders.' || lower(o_orderpriority) AS parent_job, 'COMPLETE' AS "eventType",
      {at('o_orderdate + INTERVAL 2 SECOND')} AS "eventTime",
      'INSERT INTO mart.' || lower(l_returnflag) || ' SELECT * FROM raw.lines' AS sql
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def events_of_statements(t: Tables) -> DataFrame:
    sql = F.col("job.facets.sql.query").alias("sql")
    return _told(E.sql_job_events(S.statement_runs(t)), sql)


@query(
    "L4 X13",
    """SELECT event_id, '2022-04-14 ' || lpad(CAST(hour(ts) AS varchar), 2, '0') || ':12:00' AS nominal
    FROM events""",
)
def nominal_times(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id", E.nominal_time(F.hour("ts"), "2022-04-14").alias("nominal")
    )


@query(
    "L6",
    f"""{TOUCHES}, f AS (
      SELECT name, m, unnest(CASE WHEN o_orderdate >= DATE '1998-01-01'
        THEN [{{'p': 0, 'c': 'nation', 't': 'STRING'}}, {{'p': 1, 'c': 'quantity', 't': 'BIGINT'}}, {{'p': 2, 'c': 'returned', 't': 'BOOLEAN'}}]
        ELSE [{{'p': 0, 'c': 'nation', 't': 'STRING'}}, {{'p': 1, 'c': 'quantity', 't': 'BIGINT'}}] END) AS f
      FROM touched WHERE mode = 'write')
    SELECT 'sales' AS namespace, name, f.p AS position, f.c AS "column", f.t AS type, CAST(NULL AS varchar) AS description,
      {at('min(m)')} AS first_seen, {at('max(m)')} AS last_seen FROM f GROUP BY name, f""",
)
def schema_history(t: Tables) -> DataFrame:
    return R.schema_history(_steps(t))


@query(
    "L7",
    """SELECT 'p_partkey' AS "column", count(*) AS row_count, count(*) - count(p_partkey) AS null_count,
      count(DISTINCT p_partkey) AS distinct_count, CAST(min(p_partkey) AS varchar) AS min, CAST(max(p_partkey) AS varchar) AS max FROM part
    UNION ALL SELECT 'p_brand', count(*), count(*) - count(p_brand), count(DISTINCT p_brand), min(p_brand), max(p_brand) FROM part
    UNION ALL SELECT 'size', count(*), count(*) - count(s), count(DISTINCT s), CAST(min(s) AS varchar), CAST(max(s) AS varchar)
      FROM (SELECT CASE WHEN p_size < 40 THEN p_size END AS s FROM part)""",
)
def column_profile(t: Tables) -> DataFrame:
    parts = t.part.withColumn("size", F.when(F.col("p_size") < 40, F.col("p_size")))
    return U.profile(parts, ["p_partkey", "p_brand", "size"])


@query(
    "L8",
    """SELECT count(*) AS row_count, CAST(sum(strlen(CAST(to_json(part) AS varchar))) AS bigint) AS size FROM part""",
)
def output_statistics(t: Tables) -> DataFrame:
    return U.output_stats(t.part)


@query(
    "L7 L8 D9 D10",
    f"""{TOUCHES}, n AS (SELECT l_orderkey, count(*) AS n_lines FROM lineitem GROUP BY 1)
    SELECT run_id, t AS "eventType", mode, name, n_lines FROM touched JOIN n USING (l_orderkey)""",
)
def statistics_told_by_events(t: Tables) -> DataFrame:
    def side(column: str, mode: str, told: str, key: str) -> Column:
        return F.transform(
            column,
            lambda x: F.struct(
                F.lit(mode).alias("mode"), x["name"].alias("name"), x[told][key].alias("json")
            ),
        )

    both = F.concat(
        side("inputs", "read", "inputFacets", "dataQuality"),
        side("outputs", "write", "outputFacets", "outputStatistics"),
    )
    return _steps(t).select(
        F.col("run.runId").alias("run_id"), "eventType", F.inline(both)
    ).select(
        "run_id",
        "eventType",
        "mode",
        "name",
        F.get_json_object("json", "$.rowCount").cast("bigint").alias("n_lines"),
    )


# Runs


@query(
    "L9 L20",
    f"""{RUNS} SELECT run_id, 'sales' AS namespace, job, parent AS parent_run_id, {at('started_at')} AS started_at,
      {at('ended_at')} AS ended_at, CAST(epoch(ended_at) - epoch(started_at) AS bigint) AS duration_sec,
      CASE WHEN ended_at IS NULL THEN 'START' ELSE 'COMPLETE' END AS state FROM run""",
)
def run_table(t: Tables) -> DataFrame:
    return R.runs(S.run_events(t))


@query(
    "L10",
    f"""{RUNS} SELECT job, run_id, {at('started_at')} AS started_at, CAST(recency AS int) AS recency FROM (
      SELECT *, row_number() OVER (PARTITION BY job ORDER BY started_at DESC NULLS LAST, run_id DESC) AS recency FROM run)
    WHERE recency <= 3""",
)
def latest_runs_per_job(t: Tables) -> DataFrame:
    return R.run_history(R.runs(S.run_events(t)), 3).select("job", "run_id", "started_at", "recency")


@query(
    "L11",
    f"""{RUNS}, d AS (SELECT *, CAST(epoch(ended_at) - epoch(started_at) AS bigint) AS s FROM run)
    SELECT 'sales' AS namespace, job, count(*) AS n_runs, CAST(sum(s) AS double) / count(*) AS mean_sec, max(s) AS max_sec,
      arg_max(s, {{'a': started_at, 'b': run_id}}) AS last_sec FROM d WHERE s IS NOT NULL GROUP BY job""",
)
def runtime_per_job(t: Tables) -> DataFrame:
    return R.job_runtime(R.runs(S.run_events(t)))


@query(
    "L12",
    f"""{TOUCHES} SELECT 'sales' AS namespace, name, {on('m')} AS date,
      count(DISTINCT run_id) FILTER (mode = 'read') AS n_reads, count(DISTINCT run_id) FILTER (mode = 'write') AS n_writes
    FROM touched GROUP BY name, {on('m')}""",
)
def dataset_access_per_day(t: Tables) -> DataFrame:
    return R.access_frequency(S.run_events(t))


@query(
    "L13",
    f"""{TOUCHES} SELECT DISTINCT 'sales' AS job_namespace, job, mode, 'sales' AS dataset_namespace, name AS dataset
    FROM touched""",
)
def jobs_and_datasets(t: Tables) -> DataFrame:
    return R.edges(S.run_events(t))


@query(
    "L17",
    f"""{RUNS}, rooted AS (SELECT r.*, coalesce(f.run_id, r.run_id) AS root_id, CASE WHEN f.run_id IS NULL THEN 0 ELSE 1 END AS depth
      FROM run r LEFT JOIN flow f ON f.run_id = r.parent)
    SELECT root_id, count(*) AS n_runs, CAST(max(depth) AS bigint) AS depth, {at('min(started_at)')} AS started_at,
      {at('max(ended_at)')} AS ended_at, CAST(epoch(max(ended_at)) - epoch(min(started_at)) AS bigint) AS duration_sec,
      count(*) FILTER (ended_at IS NULL) AS n_open FROM rooted GROUP BY 1""",
)
def runs_below_each_flow(t: Tables) -> DataFrame:
    return R.run_tree(R.runs(S.run_events(t)))


@query(
    "L17 L3",
    f"""{RUNS}, stmt AS (SELECT DISTINCT 'sql-' || l_orderkey || '-' || l_returnflag AS run_id, 'run-' || l_orderkey AS parent
      FROM lineitem),
    upper AS (SELECT r.run_id, coalesce(f.run_id, r.run_id) AS root_id, CASE WHEN f.run_id IS NULL THEN 0 ELSE 1 END AS depth
      FROM run r LEFT JOIN flow f ON f.run_id = r.parent)
    SELECT run_id, root_id, CAST(depth AS bigint) AS depth FROM upper
    UNION ALL SELECT stmt.run_id, root_id, depth + 1 FROM stmt JOIN upper ON upper.run_id = stmt.parent""",
)
def root_of_every_run(t: Tables) -> DataFrame:
    statements = E.sql_job_events(S.statement_runs(t))
    return R.run_roots(R.runs(S.run_events(t).union(statements)))


@query(
    "L20",
    f"""{STEPS} SELECT run_id, 'START' AS "eventType", {at('started_at')} AS "eventTime" FROM step WHERE started_at IS NOT NULL
    UNION ALL SELECT run_id, 'COMPLETE', {at('ended_at')} FROM step WHERE ended_at IS NOT NULL
    UNION ALL SELECT 'flow-' || c_custkey, 'START', {at("TIMESTAMP '1995-01-01' + to_hours(CAST(c_custkey % 24 AS int))")} FROM customer WHERE c_acctbal >= 0
    UNION ALL SELECT 'flow-' || c_custkey, 'COMPLETE', '2001-12-31 00:00:00' FROM customer WHERE c_acctbal >= 0""",
)
def events_sent_once(t: Tables) -> DataFrame:
    return R.dedupe(S.run_events(t)).select(
        F.col("run.runId").alias("run_id"), "eventType", "eventTime"
    )


@query(
    "L21",
    f"""{RUNS} SELECT 'never completed' AS problem, run_id, 1 AS n_runs FROM run WHERE ended_at IS NULL
    UNION ALL SELECT 'completed without start', run_id, 1 FROM run WHERE started_at IS NULL
    UNION ALL SELECT 'parent unknown', parent, count(*) FROM run
      WHERE parent IS NOT NULL AND parent NOT IN (SELECT run_id FROM run) GROUP BY parent""",
)
def broken_runs(t: Tables) -> DataFrame:
    return R.integrity(S.run_events(t))


@query(
    "L21",
    "SELECT o_orderkey FROM orders ANTI JOIN lineitem ON o_orderkey = l_orderkey",
)
def orders_without_lines(t: Tables) -> DataFrame:
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"))
    return t.orders.join(lines, "o_orderkey", "left_anti").select("o_orderkey")


@query(
    "L23",
    f"""SELECT event_id, {at('ts')} AS ts FROM events WHERE ts >= TIMESTAMP '2024-01-31' - INTERVAL 7 DAY""",
)
def events_of_the_last_week(t: Tables) -> DataFrame:
    now = dt.datetime(2024, 1, 31)
    return U.retain(t.events, F.lit(now).cast("timestamp_ntz"), 7, "ts").select("event_id", "ts")


@query(
    "L23",
    f"""SELECT event_id, {at('ts')} AS ts FROM events
    WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY - INTERVAL 5 HOUR""",
)
def stored_events_after_a_purge(t: Tables) -> DataFrame:
    """The log is stored by date, what is older than a week and five hours goes, the rest is read."""
    log = scratch_path(t.spark, "stored-log")
    U.write_by_date(t.events.withColumn("run", F.struct(F.col("user_id").alias("runId"))), log, "ts")
    last = t.events.agg(F.max("ts")).first()[0]
    U.purge(t.spark, log, last - dt.timedelta(hours=5), 7, "ts")
    return t.spark.read.parquet(log).select("event_id", "ts")


@query(
    "L24",
    """SELECT p_partkey, p_name, CAST(list_contains(string_split(lower(p_name), ' '), 'red') AS int)
      + CAST(list_contains(string_split(lower(p_name), ' '), 'ring') AS int) AS hits FROM part
    WHERE list_has_any(string_split(lower(p_name), ' '), ['red', 'ring'])""",
)
def search_by_name(t: Tables) -> DataFrame:
    return U.search(t.part.select("p_partkey", "p_name"), "p_name", "Red ring")


@query(
    "L25",
    f"""{TOUCHES} SELECT 'sales' AS namespace, name, {at("min(m) FILTER (mode = 'write')")} AS first_written,
      {at("max(m) FILTER (mode = 'write')")} AS last_written, {at("max(m) FILTER (mode = 'read')")} AS last_read,
      count(DISTINCT o_orderdate >= DATE '1998-01-01') FILTER (mode = 'write') AS n_versions,
      CASE arg_max(o_orderdate >= DATE '1998-01-01', m) FILTER (mode = 'write') WHEN true THEN 3 WHEN false THEN 2 END AS n_columns
    FROM touched GROUP BY name""",
)
def dataset_lifecycle(t: Tables) -> DataFrame:
    table = R.dataset_lifecycle(S.run_events(t))
    columns = F.json_array_length("current_schema")
    return table.withColumn("n_columns", columns).drop("current_schema")


@query(
    "L26",
    f"""SELECT job, 'https://code/' || job AS url, branch, version FROM (
      SELECT 'job.' || lower(o_orderstatus) AS job, o_orderpriority AS branch, 'v' || o_orderkey AS version,
        row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate DESC, o_orderpriority DESC, 'v' || o_orderkey DESC) AS r
      FROM orders) WHERE r = 1""",
)
def code_of_each_job(t: Tables) -> DataFrame:
    job = F.concat(F.lit("job."), F.lower("o_orderstatus"))
    key = F.col("o_orderkey").cast("string")
    runs = t.orders.select(
        key.alias("run_id"),
        F.lit(S.NAMESPACE).alias("namespace"),
        job.alias("job"),
        F.col("o_orderdate").alias("started_at"),
        F.concat(F.lit("https://code/"), job).alias("source_url"),
        F.col("o_orderpriority").alias("source_branch"),
        F.concat(F.lit("v"), key).alias("source_version"),
    )
    return R.job_sources(E.to_events(runs)).drop("namespace")


# Graphs


@query(
    "L14",
    """WITH RECURSIVE up AS (
      SELECT p_partkey AS label, p_partkey AS node, 0 AS depth FROM part
      UNION ALL SELECT label, node // 2, depth + 1 FROM up WHERE node > 0)
    SELECT label, node, CAST(depth AS bigint) AS depth FROM up""",
)
def all_that_a_part_is_made_from(t: Tables) -> DataFrame:
    key = F.col("p_partkey")
    return G.closure(
        S.part_tree(t), t.part.select(key.alias("label"), key.alias("node")), "upstream"
    )


@query(
    "L14 L13",
    f"""{TOUCHES}, e AS (
      SELECT DISTINCT CASE mode WHEN 'read' THEN 'dataset:sales:' || name ELSE 'job:sales:' || job END AS src,
        CASE mode WHEN 'read' THEN 'job:sales:' || job ELSE 'dataset:sales:' || name END AS dst FROM touched),
    start AS (SELECT DISTINCT src AS node FROM e WHERE src LIKE 'dataset:%')
    SELECT node AS label, node, CAST(0 AS bigint) AS depth FROM start
    UNION ALL SELECT DISTINCT node, dst, 1 FROM start JOIN e ON src = node
    UNION ALL SELECT DISTINCT node, b.dst, 2 FROM start JOIN e a ON a.src = node JOIN e b ON b.src = a.dst""",
)
def downstream_of_each_dataset(t: Tables) -> DataFrame:
    graph = R.flow_edges(cut(R.edges(S.run_events(t))))
    sources = graph.select(F.col("src").alias("node")).where(F.col("node").startswith("dataset:"))
    return G.closure(graph, sources.select(F.col("node").alias("label"), "node"))


_COLUMN_EDGES = """
e AS (SELECT 'mart.part_' || p_partkey AS out_table, 'mart.part_' || p_partkey // 2 AS in_table, p_partkey AS dst,
        CAST(p_partkey // 2 AS varchar) AS src FROM part
      UNION ALL SELECT 'mart.part_' || p_partkey, 'raw.' || lower(replace(p_brand, '#', '_')), p_partkey, p_brand FROM part)"""


@query(
    "L15 D11",
    f"WITH {_COLUMN_EDGES} SELECT DISTINCT out_table, 'rate' AS out_column, in_table, 'rate' AS in_column FROM e",
)
def column_edges(t: Tables) -> DataFrame:
    return G.column_edges(S.column_records(t))


def _lineage_log(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "lineage-log")
    eventlog.write_events(E.to_events(S.lineage_runs(t)), path)
    return eventlog.read_events(t.spark, path)


@query(
    "L15 IO8",
    f"WITH {_COLUMN_EDGES} SELECT DISTINCT out_table, 'rate' AS out_column, in_table, 'rate' AS in_column FROM e",
)
def column_edges_of_a_log(t: Tables) -> DataFrame:
    """From the column lineage that the events of a log report."""
    return G.column_edges(G.column_records(_lineage_log(t)))


@query("IO8 ST1", "SELECT 'made-' || p_partkey AS run_id, CAST(p_size AS int) AS size FROM part")
def facet_nobody_declared(t: Tables) -> DataFrame:
    """A facet of no known schema, after it was written, read, taken in by a stream to a Parquet
    log, and written and read once more."""
    first, log, last = (scratch_path(t.spark, name) for name in ("events", "ingested", "events"))
    eventlog.write_events(E.to_events(S.lineage_runs(t)), first)
    stream = eventlog.read_events(t.spark, first, streaming=True)
    J.ingest(stream, log, scratch_path(t.spark, "checkpoint"), period="month").awaitTermination()
    eventlog.write_events(t.spark.read.parquet(log).drop("event_date"), last)
    told = F.get_json_object(F.col("run.facets.other")["partSize"], "$.sizes[0].size")
    return eventlog.read_events(t.spark, last).select(
        F.col("run.runId").alias("run_id"), told.cast("int").alias("size")
    )


@query(
    "L16",
    f"""WITH RECURSIVE {_COLUMN_EDGES}, reach AS (
      SELECT in_table AS source, out_table AS node, dst, 1 AS depth FROM e WHERE in_table LIKE 'raw.%'
      UNION SELECT source, out_table, e.dst, depth + 1 FROM reach JOIN e ON e.in_table = node AND e.out_table <> node),
    least AS (SELECT source, node, dst, min(depth) AS depth FROM reach GROUP BY ALL)
    SELECT source || '.rate' AS source, node || '.rate' AS final, CAST(depth AS bigint) AS depth FROM least
    WHERE dst NOT IN (SELECT p_partkey // 2 FROM part WHERE p_partkey <> p_partkey // 2)""",
)
def final_columns_of_each_source(t: Tables) -> DataFrame:
    edges = G.column_edges(S.column_records(t))
    sources = edges.where(F.col("in_table").startswith("raw.")).select(
        F.concat_ws(".", "in_table", "in_column").alias("node")
    )
    return G.column_impact(edges, sources.distinct())


@query(
    "L22",
    """WITH RECURSIVE tag AS (
      SELECT p_partkey AS node, 'PII' AS tag FROM part WHERE p_type = 'PROMO'
      UNION SELECT p_partkey, 'SENSITIVE' FROM part WHERE p_size >= 45),
    down AS (SELECT node, tag FROM tag
      UNION SELECT p_partkey, tag FROM down JOIN part ON p_partkey > 0 AND p_partkey // 2 = node)
    SELECT node, tag FROM down""",
)
def tags_carried_downstream(t: Tables) -> DataFrame:
    key = F.col("p_partkey").alias("node")
    pii = t.part.where(F.col("p_type") == "PROMO").select(key, F.lit("PII").alias("tag"))
    sensitive = t.part.where(F.col("p_size") >= 45).select(key, F.lit("SENSITIVE").alias("tag"))
    return G.propagate_tags(S.part_tree(t), pii.union(sensitive))


# Statements

_SCRIPTS = """
WITH script AS (SELECT p_partkey AS script_id,
  'CREATE OR REPLACE TABLE mart.part_' || p_partkey || ' AS WITH recent AS ( SELECT * FROM mart.part_' || p_partkey // 2 ||
  ' ) SELECT r.* FROM recent r JOIN raw.' || lower(replace(p_brand, '#', '_')) || ' b ON r.id = b.id' AS one,
  'insert into audit.' || lower(p_type) || ' SELECT count(*) FROM mart.part_' || p_partkey AS two, * FROM part)"""


@query(
    "L18 S4",
    f"""{_SCRIPTS} SELECT script_id, 0 AS index, one AS statement FROM script
    UNION ALL SELECT script_id, 1, two FROM script""",
)
def statements_of_each_script(t: Tables) -> DataFrame:
    return Q.first_statements(Q.split_statements(S.scripts(t)), 8)


@query(
    "S4",
    f"{_SCRIPTS} SELECT script_id, one AS statement FROM script",
)
def first_statement_of_each_script(t: Tables) -> DataFrame:
    return Q.first_statements(Q.split_statements(S.scripts(t)), 1).drop("index")


@query(
    "L19",
    f"""{_SCRIPTS} SELECT script_id, 0 AS index, 'mart.part_' || script_id AS out_table, 'mart.part_' || script_id // 2 AS in_table FROM script
    UNION ALL SELECT script_id, 0, 'mart.part_' || script_id, 'raw.' || lower(replace(p_brand, '#', '_')) FROM script
    UNION ALL SELECT script_id, 1, 'audit.' || lower(p_type), 'mart.part_' || script_id FROM script""",
)
def tables_of_each_statement(t: Tables) -> DataFrame:
    tables = Q.statement_tables(Q.split_statements(S.scripts(t)))
    return tables.select("script_id", "index", "out_table", F.explode("in_tables").alias("in_table"))


@query(
    "L19 L14",
    """SELECT DISTINCT 'mart.part_' || p_partkey // 2 AS src, 'mart.part_' || p_partkey AS dst FROM part
    UNION SELECT 'raw.' || lower(replace(p_brand, '#', '_')), 'mart.part_' || p_partkey FROM part
    UNION SELECT 'mart.part_' || p_partkey, 'audit.' || lower(p_type) FROM part""",
)
def table_graph_of_a_statement_log(t: Tables) -> DataFrame:
    return Q.table_edges(Q.statement_tables(Q.split_statements(S.scripts(t))))


# The report

_REPORT = f"""{RUNS}, event AS (
  SELECT run_id, job, CASE WHEN job LIKE '%1-urgent' THEN 2 ELSE 1 END AS sent FROM run WHERE started_at IS NOT NULL
  UNION ALL SELECT run_id, job, CASE WHEN job LIKE '%1-urgent' THEN 2 ELSE 1 END FROM run WHERE ended_at IS NOT NULL),
rooted AS (SELECT r.*, coalesce(f.run_id, r.run_id) AS root_id, CASE WHEN f.run_id IS NULL THEN 0 ELSE 1 END AS depth
  FROM run r LEFT JOIN flow f ON f.run_id = r.parent),
tree AS (SELECT root_id, count(*) AS n, max(depth) AS depth, count(*) FILTER (ended_at IS NULL) AS n_open FROM rooted GROUP BY 1),
link AS (SELECT DISTINCT job, 'read' AS mode, 'raw.' || lower(p_brand) AS name
  FROM step JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey
  UNION SELECT DISTINCT job, 'write', 'mart.nation_' || s_nationkey
  FROM step JOIN lineitem ON o_orderkey = l_orderkey JOIN supplier ON l_suppkey = s_suppkey),
reach AS (SELECT name AS source, job AS node FROM link WHERE mode = 'read'
  UNION SELECT a.name, b.name FROM link a JOIN link b ON a.job = b.job AND a.mode = 'read' AND b.mode = 'write')
SELECT 'log' AS section, 'events' AS name, CAST(sum(sent) AS bigint) AS value FROM event
UNION ALL SELECT 'log', 'distinct events', count(*) FROM event
UNION ALL SELECT 'runs', CASE WHEN ended_at IS NULL THEN 'START' ELSE 'COMPLETE' END, count(*) FROM run GROUP BY 2
UNION ALL SELECT 'trees', 'trees', count(*) FROM tree
UNION ALL SELECT 'trees', 'depth', max(depth) FROM tree
UNION ALL SELECT 'trees', 'largest', max(n) FROM tree
UNION ALL SELECT 'trees', 'open', CAST(sum(n_open) AS bigint) FROM tree
UNION ALL SELECT 'graph', mode, count(*) FROM link GROUP BY 2
UNION ALL SELECT 'graph', 'reachable', count(*) FROM reach
UNION ALL SELECT 'findings', 'never completed', count(*) FROM run WHERE ended_at IS NULL
UNION ALL SELECT 'findings', 'completed without start', count(*) FROM run WHERE started_at IS NULL
UNION ALL SELECT 'findings', 'parent unknown', count(DISTINCT parent) FROM run
  WHERE parent IS NOT NULL AND parent NOT IN (SELECT run_id FROM run)"""


@query("PIPE10", _REPORT)
def lineage_report_of_the_log(t: Tables) -> DataFrame:
    return lineage_report(S.run_events(t))
