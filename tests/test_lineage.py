"""Event tables, graphs and statements on literal logs."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from stocktrail.lineage import events as E, graph as G, runs as R, statements as Q, upkeep as U
from stocktrail.plans.lineage_report import lineage_report
from stocktrail.sources import eventlog
from stocktrail.session import cut
from tests.conftest import rows

T0 = dt.datetime(2024, 1, 1, 10)


def at(seconds: int) -> dt.datetime:
    return T0 + dt.timedelta(seconds=seconds)


_RUN = (
    "run_id string, namespace string, job string, started_at timestamp, ended_at timestamp,"
    " parent_run_id string, parent_namespace string, parent_job string,"
    " reads array<string>, writes array<string>"
)


def _events(spark, data):
    runs = spark.createDataFrame(data, _RUN)
    named = lambda n: E.dataset(F.lit("ns"), n)
    return E.to_events(
        runs.withColumns(
            {
                "inputs": F.transform(F.coalesce("reads", F.array().cast("array<string>")), named),
                "outputs": F.transform(F.coalesce("writes", F.array().cast("array<string>")), named),
            }
        ).drop("reads", "writes")
    )


def _flow(spark):
    """A flow of four steps, one of them with three statements whose parent id nobody has: 8 runs."""

    def step(name, reads=None, writes=None):
        return (f"r-{name}", "ns", f"flow.{name}", at(1), at(6), "r-flow", "ns", "flow", reads, writes)

    def statement(table, reads, writes):
        return (f"r-{table}", "ns", f"execute_sql.{table}", at(2), at(4), "r-lost", "ns",
                "flow.prepare", reads, writes)

    return _events(
        spark,
        [
            ("r-flow", "ns", "flow", at(0), at(60), None, None, None, None, None),
            step("start"),
            step("prepare", ["sales", "places"], ["clean", "rich", "features"]),
            step("train", ["features"], ["model"]),
            step("end"),
            statement("clean", ["sales"], ["clean"]),
            statement("rich", ["clean", "places"], ["rich"]),
            statement("features", ["rich"], ["features"]),
        ],
    )


def test_flow_has_sixteen_events_and_eight_runs(spark):
    events = _flow(spark)
    assert events.count() == 16
    table = R.runs(events)
    assert table.count() == 8 and table.where("state = 'COMPLETE'").count() == 8
    assert rows(table.where("job LIKE 'execute%'"), "duration_sec") == [(2,)] * 3


def test_parents_nobody_ran(spark):
    assert rows(R.integrity(_flow(spark))) == [("parent unknown", "r-lost", 3)]


def test_tree_of_the_flow(spark):
    tree = R.run_tree(R.runs(_flow(spark)))
    got = {r.root_id: (r.n_runs, r.depth, r.duration_sec) for r in tree.collect()}
    assert got == {"r-flow": (5, 1, 60), "r-clean": (1, 0, 2), "r-rich": (1, 0, 2), "r-features": (1, 0, 2)}


def test_deep_tree_and_cycle_of_parents(spark):
    chain = [(f"c{i}", "ns", "j", at(i), None, f"c{i - 1}" if i else None, "ns", "j", None, None)
             for i in range(12)]
    loop = [(f"x{i}", "ns", "j", at(0), None, f"x{(i + 1) % 3}", "ns", "j", None, None) for i in range(3)]
    below = [("y", "ns", "j", at(0), None, "x0", "ns", "j", None, None)]
    events = _events(spark, chain + loop + below)
    roots = R.run_roots(R.runs(events))
    circling = ["x0", "x1", "x2", "y"]
    assert rows(roots, "depth", "run_id", "root_id") == [(None, x, None) for x in circling] + [
        (i, f"c{i}", "c0") for i in range(12)
    ]
    found = rows(R.integrity(events).where("problem = 'parents in a cycle'"), "run_id", "n_runs")
    assert found == [(x, 1) for x in circling]
    tree = {r.root_id: (r.n_runs, r.depth) for r in R.run_tree(R.runs(events)).collect()}
    assert tree == {"c0": (12, 11), None: (4, None)}


def test_events_are_sorted_for_their_copies_after_the_shuffle_alone(spark):
    events = _flow(spark)
    sent = events.union(events)
    plan = R.dedupe(sent)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(_run") == 1
    above, below = plan.split("Exchange hashpartitioning(_run")
    assert "Sort" in above and "Sort" not in below and "Aggregate" not in below
    assert rows(R.dedupe(sent).select(F.to_json(F.struct("*")).alias("e"))) == rows(
        events.select(F.to_json(F.struct("*")).alias("e"))
    )


def test_roots_work_the_run_table_out_once(spark, tmp_path, monkeypatch):
    chain = [(f"c{i}", "ns", "j", at(i), None, f"c{i - 1}" if i else None, "ns", "j", None, None)
             for i in range(5)]
    _events(spark, chain).write.parquet(str(tmp_path / "log"))
    plans = []

    def noted(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df)

    monkeypatch.setattr(R, "cut", noted)
    roots = R.run_roots(R.runs(spark.read.parquet(str(tmp_path / "log"))))
    assert rows(roots, "depth", "root_id", "run_id") == [(i, "c0", f"c{i}") for i in range(5)]
    assert sum(len(re.findall("FileScan parquet", plan)) for plan in plans) == 1


def test_a_parent_with_most_of_the_runs(spark):
    data = [("top", "ns", "t", at(0), at(9), None, None, None, None, None)] + [
        (f"s{i}", "ns", "s", at(1), at(2), "top", "ns", "t", None, None) for i in range(300)
    ]
    got = R.run_tree(R.runs(_events(spark, data))).first()
    assert (got.root_id, got.n_runs, got.depth) == ("top", 301, 1)


def test_repeated_missing_and_early_events(spark):
    """A copy, a run without end, one without start, one whose end was logged first."""
    events = _events(
        spark,
        [
            ("a", "ns", "j", at(0), at(5), None, None, None, ["d"], None),
            ("b", "ns", "j", at(1), None, None, None, None, ["d"], None),
            ("c", "ns", "j", None, at(7), None, None, None, None, ["d"]),
        ],
    )
    sent = events.orderBy(F.col("eventTime").desc()).union(events)
    assert R.dedupe(sent).count() == 4
    assert rows(R.runs(sent), "run_id", "state", "duration_sec") == [
        ("a", "COMPLETE", 5),
        ("b", "START", None),
        ("c", "COMPLETE", None),
    ]
    assert rows(R.integrity(sent), "problem", "run_id") == [
        ("completed without start", "c"),
        ("never completed", "b"),
    ]
    # START and COMPLETE repeat the datasets: two runs read, not four events.
    assert rows(R.access_frequency(sent), "name", "n_reads", "n_writes") == [("d", 2, 1)]


def test_run_history_breaks_ties_by_run_id(spark):
    events = _events(
        spark, [(f"r{i}", "ns", "j", at(0), None, None, None, None, None, None) for i in range(4)]
    )
    assert rows(R.run_history(R.runs(events), 2), "run_id", "recency") == [("r2", 2), ("r3", 1)]


def test_schema_versions_and_sources(spark):
    def fields(*names):
        return F.array(*[
            F.struct(F.lit(n).alias("name"), F.lit("INT").alias("type"), F.lit(None).cast("string").alias("description"))
            for n in names
        ])

    base = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2)], "run_id string, n int").withColumns(
        {
            "namespace": F.lit("ns"),
            "job": F.lit("j"),
            "started_at": F.lit(T0) + F.make_dt_interval(F.col("n")),
            "outputs": F.array(
                E.dataset(F.lit("ns"), F.lit("t"), F.when(F.col("n") == 2, fields("x", "y")).otherwise(fields("x")))
            ),
            "source_url": F.concat(F.lit("url"), F.col("n").cast("string")),
        }
    )
    events = E.to_events(base)
    life = R.dataset_lifecycle(events).first()
    assert life.n_versions == 2 and '"y"' in life.current_schema and life.last_read is None
    assert rows(R.schema_history(events), "position", "column") == [(0, "x"), (1, "y")]
    assert rows(R.job_sources(events), "job", "url") == [("j", "url2")]


def test_schemas_of_a_dataset_that_is_also_read(spark):
    """Reads say nothing about the schema, nor do writes that report none."""
    writes = _events(spark, [("w", "ns", "j", at(0), at(9), None, None, None, None, ["t"])])
    reads = _events(spark, [("r", "ns", "k", at(20), at(30), None, None, None, ["t"], None)])
    life = R.dataset_lifecycle(writes.union(reads)).first()
    assert (life.first_written, life.last_written, life.last_read) == (at(0), at(9), at(30))
    assert (life.n_versions, life.current_schema) == (0, None)


@pytest.mark.parametrize("table", [R.runs, R.dataset_lifecycle, R.job_sources])
def test_the_log_is_hashed_not_sorted(spark, table):
    plan = table(_flow(spark))._jdf.queryExecution().executedPlan().toString()
    below_first_shuffle = plan.rsplit("Exchange", 1)[1]
    assert "HashAggregate" in below_first_shuffle and "SortAggregate" not in below_first_shuffle


def test_unknown_facets_are_ignored_on_reading(spark, tmp_path):
    (tmp_path / "log.json").write_text(
        '{"eventType":"START","eventTime":"2024-01-01T00:00:00+02:00","run":{"runId":"a",'
        '"facets":{"odd":{"x":1}}},"job":{"namespace":"n","name":"j"},"inputs":[],"outputs":[]}\n'
    )
    event = eventlog.read_events(spark, str(tmp_path)).select(
        "run.runId", F.date_format("eventTime", "yyyy-MM-dd HH").alias("at")
    ).first()
    assert tuple(event) == ("a", "2023-12-31 22")


def test_unknown_facets_survive_reading_and_writing(spark, tmp_path):
    import json

    said = {
        "eventType": "START", "eventTime": "2024-01-01T00:00:00.000Z",
        "run": {"runId": "a", "facets": {"odd": {"x": [1, {"y": None}], "z": "\u00e9\"q"}, "nominalTime": {"nominalStartTime": "2024-01-01T00:00:00.000Z"}}},
        "job": {"namespace": "n", "name": "j", "facets": {"sql": {"query": "select 1"}, "mine": {"deep": {"deeper": True}}}},
        "inputs": [{"namespace": "n", "name": "i", "facets": {"schema": {"fields": [{"name": "c", "type": "INT"}]}, "new": {"v": 1.5}}}],
        "outputs": [{"namespace": "n", "name": "o"}],
    }
    (tmp_path / "log.json").write_text(json.dumps(said) + "\n\nno event\n")
    events = eventlog.read_events(spark, str(tmp_path / "log.json")).where("eventType is not null")
    event = events.first()
    assert event.run.facets.nominalTime.nominalStartTime and event.job.facets.sql.query == "select 1"
    assert json.loads(event.run.facets.other["odd"]) == said["run"]["facets"]["odd"]
    assert list(event.inputs[0].facets.other) == ["new"] and event.outputs[0].facets is None
    eventlog.write_events(events, str(tmp_path / "again"))
    text = [line for p in (tmp_path / "again").glob("*.json") for line in p.read_text().splitlines()]
    assert [json.loads(line) for line in text] == [said]
    assert eventlog.read_events(spark, str(tmp_path / "again")).first() == event


def test_column_lineage_is_read_from_events(spark):
    made_of = F.create_map(
        F.lit("total"),
        F.array(*[F.struct(F.lit("n").alias("namespace"), F.lit("t").alias("name"), F.lit(c).alias("field")) for c in "ab"]),
    )
    base = spark.createDataFrame([("r1", T0)], "run_id string, started_at timestamp").withColumns(
        {"namespace": F.lit("n"), "job": F.lit("j"), "outputs": F.array(E.dataset("namespace", F.lit("o"), made_of=made_of))}
    )
    edges = G.column_edges(G.column_records(E.to_events(base).unionAll(E.to_events(base))))
    assert rows(edges, "out_table", "out_column", "in_table", "in_column") == [("o", "total", "t", "a"), ("o", "total", "t", "b")]


def test_purge_drops_days_and_rewrites_the_boundary_alone(spark, tmp_path):
    day = lambda d, h: dt.datetime(2024, 1, d, h)
    events = spark.createDataFrame(
        [(f"r{d}{h}", day(d, h)) for d in (1, 2, 3, 4) for h in (1, 13)], "id string, at timestamp"
    ).withColumn("run", F.struct(F.col("id").alias("runId")))
    log = str(tmp_path / "log")
    U.write_by_date(events, log, "at")
    untouched = {p.name for d in (3, 4) for p in (tmp_path / "log" / f"event_date=2024-01-0{d}").glob("*.parquet")}
    U.purge(spark, log, day(4, 12), 2, "at")
    assert rows(spark.read.parquet(log), "id") == [("r213",), ("r31",), ("r313",), ("r41",), ("r413",)]
    assert not (tmp_path / "log" / "event_date=2024-01-01").exists()
    assert untouched == {p.name for d in (3, 4) for p in (tmp_path / "log" / f"event_date=2024-01-0{d}").glob("*.parquet")}
    (tmp_path / "log" / "event_date=2024-01-02").rename(tmp_path / "log" / "_purged-2024-01-02")
    U.purge(spark, log, day(4, 12), 2, "at")  # again, after a stop before the last step
    assert spark.read.parquet(log).count() == 5
    U.purge(spark, log, day(5, 14), 2, "at")  # nothing of the boundary's day is left
    assert rows(spark.read.parquet(log), "id") == [("r41",), ("r413",)]


def test_gzip_log_is_compressed(spark, tmp_path):
    eventlog.write_events(_flow(spark), str(tmp_path / "log"), compression="gzip")
    assert list((tmp_path / "log").glob("*.json.gz"))
    assert eventlog.read_events(spark, str(tmp_path / "log")).count() == 16


def test_retention_and_writing_by_date(spark, tmp_path):
    events = _flow(spark).union(
        _events(spark, [("old", "ns", "j", T0 - dt.timedelta(days=8), None, None, None, None, None, None)])
    )
    U.write_by_date(events, str(tmp_path / "log"))
    U.write_by_date(events, str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    assert log.count() == 17
    kept = U.retain(log, F.lit(T0), 7)
    assert kept.count() == 16
    scan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in scan


def test_a_day_with_most_events_is_written_by_many_tasks(spark, tmp_path):
    """Small days are one file each; the events come from eight tasks, so a day is at most eight files."""
    shift = F.expr("make_dt_interval(CAST(IF(id % 1000 = 1, id % 7, 0) AS int))")
    events = spark.range(0, 40_000, 1, 8).select(
        (F.lit(T0) + shift).alias("eventTime"), F.sha2(F.col("id").cast("string"), 256).alias("x")
    )
    small = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "64",
    }
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        U.write_by_date(events, str(tmp_path / "log"))
    finally:
        for key in small:
            spark.conf.unset(key)
    files = {d.name: len(list(d.glob("*.parquet"))) for d in (tmp_path / "log").glob("event_date=*")}
    assert len(files) == 7 and files.pop("event_date=2024-01-01") > 3 and max(files.values()) <= 2
    assert spark.read.parquet(str(tmp_path / "log")).count() == 40_000


def test_retention_of_a_log_by_month(spark, tmp_path):
    events = _flow(spark)
    U.write_by_date(events, str(tmp_path / "log"), period="month")
    log = spark.read.parquet(str(tmp_path / "log"))
    assert U.retain(log, F.lit(at(30)), 7, period="month").count() == 16


def test_facets_of_inputs_and_outputs(spark):
    runs = spark.createDataFrame([("a", T0)], "run_id string, started_at timestamp").withColumns(
        {
            "namespace": F.lit("ns"),
            "job": F.lit("j"),
            "inputs": F.array(E.input_dataset(F.lit("ns"), F.lit("i"), F.struct(F.lit(3).alias("rowCount")))),
            "outputs": F.array(E.output_dataset(F.lit("ns"), F.lit("o"), F.struct(F.lit(5).alias("size")))),
        }
    )
    event = E.to_events(runs).first()
    assert event.inputs[0].inputFacets == {"dataQuality": '{"rowCount":3}'}
    assert event.outputs[0].outputFacets == {"stats": '{"size":5}', "outputStatistics": '{"size":5}'}


def test_search_ranks_by_hits(spark):
    df = spark.createDataFrame([("red ring",), ("blue ring",), ("red_box",), ("ringing",)], "n string")
    assert [r.n for r in U.search(df, "n", "RED ring").collect()] == ["red ring", "blue ring", "red_box"]
    with pytest.raises(ValueError):
        U.search(df, "n", " ")


def test_profile_and_statistics(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, "b")], "x int, y string")
    assert rows(U.profile(df)) == [("x", 3, 0, 2, "1", "2"), ("y", 3, 1, 2, "a", "b")]
    assert U.output_stats(df).first().row_count == 3
    assert rows(U.profile(df.limit(0), ["y"])) == [("y", 0, 0, 0, None, None)]
    assert rows(U.profile(df.withColumnRenamed("y", "a.b"), ["a.b"])) == [("a.b", 3, 1, 2, "a", "b")]


def test_a_profile_copies_no_rows_and_reads_each_column_alone(spark, tmp_path):
    data = spark.range(1000).select(F.lit("hot").alias("x"), "id", (F.col("id") % 7).cast("double").alias("y"))
    data.write.parquet(str(tmp_path / "t"))
    profile = U.profile(spark.read.parquet(str(tmp_path / "t")))
    plan = profile._jdf.queryExecution().executedPlan().toString()
    assert rows(profile) == [
        ("id", 1000, 0, 1000, "0", "999"), ("x", 1000, 0, 1, "hot", "hot"), ("y", 1000, 0, 7, "0.0", "6.0")
    ]
    assert "Expand" not in plan and plan.count("ReadSchema") == 3
    for schema in ("struct<x:string>", "struct<id:bigint>", "struct<y:double>"):
        assert f"ReadSchema: {schema}" in plan


# Graphs


def _graph(spark, *pairs):
    return spark.createDataFrame(list(pairs), "src string, dst string")


def _start(spark, *nodes):
    return spark.createDataFrame([(n, n) for n in nodes], "label string, node string")


def test_diamond_takes_the_least_number_of_steps(spark):
    graph = _graph(spark, ("a", "b"), ("a", "c"), ("b", "d"), ("c", "d"), ("a", "d"), ("d", "e"))
    assert rows(G.closure(graph, _start(spark, "a")), "node", "depth") == [
        ("a", 0), ("b", 1), ("c", 1), ("d", 1), ("e", 2)
    ]
    assert rows(G.closure(graph, _start(spark, "e"), "upstream", max_depth=1), "node") == [("d",), ("e",)]


def test_cycles_and_self_loops_end(spark):
    graph = _graph(spark, ("a", "b"), ("b", "c"), ("c", "a"), ("a", "a"))
    assert rows(G.closure(graph, _start(spark, "a", "b")), "label", "node", "depth") == [
        ("a", "a", 0), ("a", "b", 1), ("a", "c", 2), ("b", "a", 2), ("b", "b", 0), ("b", "c", 1)
    ]


def test_long_chain_and_hub(spark):
    """More rounds than are kept apart, and one node with most of the edges."""
    chain = [(f"n{i}", f"n{i + 1}") for i in range(11)]
    hub = [("n11", f"leaf{i}") for i in range(200)]
    reached = G.closure(_graph(spark, *chain, *hub), _start(spark, "n0"))
    assert reached.count() == 212 and reached.agg(F.max("depth")).first()[0] == 12


def test_unknown_direction(spark):
    with pytest.raises(ValueError):
        G.closure(_graph(spark, ("a", "b")), _start(spark, "a"), "sideways")


def test_column_impact(spark):
    records = spark.createDataFrame(
        [("rich", "price", [("clean", "price")]), ("clean", "price", [("sales", "price")]),
         ("features", "ratio", [("rich", "price"), ("rich", "size")])],
        "out_table string, out_column string, lineage array<struct<table string, column string>>",
    )
    edges = G.column_edges(records)
    assert edges.count() == 4
    start = spark.createDataFrame([("sales.price",), ("rich.size",)], "node string")
    assert rows(G.column_impact(edges, start)) == [
        ("rich.size", "features.ratio", 1), ("sales.price", "features.ratio", 3)
    ]


def test_tags_go_downstream_only(spark):
    graph = _graph(spark, ("a", "b"), ("b", "c"), ("x", "c"))
    tags = spark.createDataFrame([("b", "PII"), ("x", "SENSITIVE")], "node string, tag string")
    assert rows(G.propagate_tags(graph, tags)) == [
        ("b", "PII"), ("c", "PII"), ("c", "SENSITIVE"), ("x", "SENSITIVE")
    ]


# Statements

_SCRIPT = """
-- first; a comment
create or replace temporary table clean as select * from sales where price between 1 and 2;
/* second; too */ CREATE TABLE rich AS WITH near AS (SELECT * FROM db.places), big AS (SELECT * FROM near)
  SELECT s.*, l.zip FROM clean s JOIN big l ON s.id = l.id;;
INSERT INTO rich SELECT * FROM rich;
SET x = 1
"""


def test_statements_of_a_script(spark):
    scripts = spark.createDataFrame([(1, _SCRIPT), (2, " ; ")], "id int, text string")
    statements = Q.split_statements(scripts)
    assert [r["index"] for r in statements.orderBy("index").collect()] == [0, 1, 2, 3]
    tables = {r["index"]: (r.out_table, sorted(r.in_tables)) for r in Q.statement_tables(statements).collect()}
    assert tables == {
        0: ("clean", ["sales"]),
        1: ("rich", ["clean", "db.places"]),
        2: ("rich", ["rich"]),
        3: (None, []),
    }
    assert Q.first_statements(statements, 2).count() == 2


def test_report_on_the_flow(spark):
    figures = {(r.section, r.name): r.value for r in lineage_report(_flow(spark)).collect()}
    assert figures[("log", "events")] == 16 and figures[("runs", "COMPLETE")] == 8
    assert figures[("trees", "trees")] == 4 and figures[("findings", "parent unknown")] == 1
    assert figures[("graph", "read")] == 7 and figures[("graph", "write")] == 7


def test_an_empty_log(spark):
    empty = _events(spark, [])
    figures = {(r.section, r.name): r.value for r in lineage_report(empty).collect()}
    assert figures[("log", "events")] == 0 and ("findings", "parent unknown") not in figures


def test_a_walk_broadcasts_nothing(spark, monkeypatch, tmp_path):
    """Edges and reached rows are as large as the log, however small their files look."""
    plans = []

    def recorded(df):
        plans.append(df._jdf.queryExecution().toString())
        return cut(df)

    monkeypatch.setattr(G, "cut", recorded)
    spark.createDataFrame(
        [("a", "x", "raw", "x"), ("b", "x", "a", "x"), ("c", "x", "b", "x")],
        "out_table string, out_column string, in_table string, in_column string",
    ).write.parquet(f"{tmp_path}/edges")
    edges = spark.read.parquet(f"{tmp_path}/edges")
    sources = spark.createDataFrame([("raw.x",)], "node string")
    got = G.column_impact(edges, sources)
    plans.append(got._jdf.queryExecution().toString())
    assert rows(got, "source", "final", "depth") == [("raw.x", "c.x", 3)]
    assert sum("SortMergeJoin" in plan for plan in plans) > 3
    assert not [plan for plan in plans if "BroadcastExchange" in plan]


def test_the_text_of_an_event_is_parsed_once(spark, tmp_path):
    (tmp_path / "log.json").write_text('{"eventType": "START", "run": {"runId": "a"}}\n')
    events = eventlog.read_events(spark, str(tmp_path / "log.json")).select(
        "eventType", "eventTime", "run.runId", "job.name", "run.facets.parent.run.runId", F.size("inputs")
    )
    plan = events._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"from_json\(.*?, value#\d+", plan)) == 1
