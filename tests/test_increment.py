"""Run, replay, edit, skip, fail, restart: the life of a corpus."""

import json
import re

import pytest
from pyspark.sql import functions as F

from codetide import contract
from codetide.operators import changelog, checks, fold
from codetide.operators.syntax import FILE
from codetide.plans.increment import run
from codetide.session import fresh_path
from codetide.sources.events import discard, envelope_lines, kafka_records, write_lines
from codetide.sources.state import StateTables
from tests.test_extract import SAMPLE

# a branch ends the function instead of the loop, a method has another name
EDITED = SAMPLE.replace("            break\n", "            return\n").replace("def clear(", "def purge(")
AT = "2024-01-01T00:00:00.000Z"


@pytest.fixture
def place(spark):
    root = fresh_path(spark, "test-run")
    return StateTables(spark, f"{root}/state"), f"{root}/log"


def summary(result):
    return result.summary.first().asDict()


def ids(log, kind, column):
    return {r[0] for r in log.filter(F.col("event_type") == kind).select(column).collect()}


def test_run_replay_edit_skip_and_failure(spark, corpus, place):
    state, log = place
    first = run(corpus({"a.py": SAMPLE, "b.py": "x = 1\n"}), state, log, 1, event_time=AT)
    one = summary(first)
    assert (one["files_total"], one["succeeded"], one["deleted_nodes"], one["deleted_edges"]) == (2, 2, 0, 0)
    nodes_1 = ids(first.log, "node_upsert", "node.node_id")
    edges_1 = ids(first.log, "edge_upsert", "edge.edge_id")
    assert len(nodes_1) == one["nodes"] and len(edges_1) == one["edges"]

    # the same again: everything is upserted anew, nothing deleted
    second = run(corpus({"a.py": SAMPLE, "b.py": "x = 1\n"}), state, log, 2, event_time=AT)
    two = summary(second)
    assert (two["deleted_nodes"], two["deleted_edges"], two["nodes"]) == (0, 0, one["nodes"])
    assert ids(second.log, "node_upsert", "node.node_id") == nodes_1

    # one edit, with unchanged files skipped
    third = run(corpus({"a.py": EDITED, "b.py": "x = 1\n"}), state, log, 3, skip_unchanged=True, event_time=AT)
    three = summary(third)
    assert (three["skipped"], three["succeeded"]) == (1, 1)
    assert three["deleted_nodes"] > 0 and three["deleted_edges"] > 0
    gone = ids(third.log, "node_delete", "node.node_id")
    assert gone == {i for i in nodes_1 - ids(third.log, "node_upsert", "node.node_id")
                    if i not in ids(first.log.filter("file_path = 'b.py'"), "node_upsert", "node.node_id")}
    # a deleted edge carries the source it had
    sources = {r["edge_id"]: r["src_node_id"] for r in first.log.filter("event_type = 'edge_upsert'").select("edge.*").collect()}
    for r in third.log.filter("event_type = 'edge_delete'").select("key", "edge.*").collect():
        assert r["src_node_id"] == sources[r["edge_id"]] == r["key"]

    # old - deleted + added = new
    keys = [*FILE, "node_id"]
    before = first.log.filter("event_type = 'node_upsert' and file_path = 'a.py'").select(*FILE, "node.node_id")
    after = state.ids("nodes").filter("file_path = 'a.py'").select(*keys)
    removed = third.log.filter("event_type = 'node_delete'").select(*FILE, "node.node_id")
    added = after.join(before, keys, "left_anti")
    assert checks.reconcile(before, removed, added, after, FILE).filter("not balanced").count() == 0

    # nothing changed: nothing is emitted
    fourth = run(corpus({"a.py": EDITED, "b.py": "x = 1\n"}), state, log, 4, skip_unchanged=True, event_time=AT)
    assert summary(fourth)["skipped"] == 2 and fourth.log.count() == 0

    # a broken file emits one error, keeps its old state, and does not stop the others
    fifth = run(corpus({"a.py": "def broken(:\n", "b.py": "x = 2\n"}), state, log, 5, event_time=AT)
    five = summary(fifth)
    assert (five["failed"], five["succeeded"], five["run_failed"]) == (1, 1, True)
    bad = fifth.log.filter("topic = 'cpg.parser.error.events'").collect()
    assert len(bad) == 1 and bad[0]["key"] == "a.py" and bad[0]["failure"]["stage"] == "ast_parse"
    assert fifth.log.filter("file_path = 'a.py'").count() == 1
    kept = {r[0] for r in state.ids("nodes").filter("file_path = 'a.py'").select("node_id").collect()}
    assert kept == {r["node_id"] for r in after.collect()}

    # compaction changes nothing that can be read
    was = {t: {tuple(r) for r in state.ids(t).collect()} for t in ("nodes", "edges")}
    state.compact(6)
    assert state.committed_runs() == [6]
    assert {t: {tuple(r) for r in state.ids(t).collect()} for t in ("nodes", "edges")} == was
    seventh = run(corpus({"a.py": EDITED, "b.py": "x = 2\n"}), state, log, 7, skip_unchanged=True, event_time=AT)
    assert summary(seventh)["skipped"] == 2

    # the views folded from all runs hold exactly the current ids
    whole = first.log
    for r in (second, third, fourth, fifth):
        whole = whole.unionByName(r.log)
    order = ["run_id", "phase"]
    nodes, edges = fold.graph_view(changelog.node_events(whole), changelog.edge_events(whole), order)
    assert {r[0] for r in nodes.select("node_id").collect()} == {r[2] for r in was["nodes"]}
    assert {r[0] for r in edges.select("edge_id").collect()} == {r[2] for r in was["edges"]}
    assert nodes.filter("is_stub").count() == 0


def test_a_run_that_dies_before_its_commit_leaves_the_old_state(spark, corpus, place, monkeypatch):
    state, log = place
    run(corpus({"a.py": SAMPLE}), state, log, 1, event_time=AT)
    before = {tuple(r) for r in state.ids("nodes").collect()}

    def dies(*args, **kwargs):
        raise RuntimeError("lost")

    monkeypatch.setattr(state, "commit", dies)
    with pytest.raises(RuntimeError):
        run(corpus({"a.py": EDITED}), state, log, 2, event_time=AT)
    monkeypatch.undo()
    assert {tuple(r) for r in state.ids("nodes").collect()} == before
    again = run(corpus({"a.py": EDITED}), state, log, 2, event_time=AT)
    assert summary(again)["deleted_nodes"] > 0
    # the repeated run left one copy of its log
    assert again.log.filter("event_type = 'source_upsert'").count() == 1


def test_released_runs_leave_log_and_state(spark, corpus, place):
    from codetide.sources.files import exists

    state, log = place
    result = run(corpus({"a.py": SAMPLE}), state, log, 1, event_time=AT)
    assert exists(spark, result.area.root)
    result.release()
    assert not exists(spark, result.area.root)
    assert result.log.count() > 0 and state.ids("nodes").count() > 0


def test_ids_of_few_files_read_their_buckets(spark, corpus, place):
    state, log = place
    files = {f"p{i}.py": f"x{i} = {i}\n" for i in range(20)}
    run(corpus(files), state, log, 1, event_time=AT)
    one = spark.createDataFrame([("example/repo", "p3.py")], "repository string, file_path string")
    found = state.ids("nodes", one)
    assert {r["file_path"] for r in found.collect()} == {"p3.py"}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"PartitionFilters: \[[^\]]*bucket#", plan)) >= 2  # files and ids
    assert StateTables(spark, state.root, 999).buckets == state.buckets  # as the tables were made


def test_two_repositories_do_not_share_state(corpus, place):
    state, log = place
    one = corpus({"a.py": SAMPLE}, "one").unionByName(corpus({"a.py": "y = 2\n"}, "two"))
    run(one, state, log, 1, event_time=AT)
    result = run(one, state, log, 2, event_time=AT)
    assert summary(result)["deleted_nodes"] == 0


def test_order_contract_and_envelopes(spark, corpus, place):
    state, log_path = place
    run(corpus({"a.py": SAMPLE}), state, log_path, 1, event_time=AT)
    log = run(corpus({"a.py": EDITED}), state, log_path, 2, event_time=AT).log
    assert contract.violations(log).count() == 0
    ordered = changelog.with_sequence(log).orderBy("seq").collect()
    assert [r["seq"] for r in ordered] == list(range(1, len(ordered) + 1))
    phases = [r["phase"] for r in ordered]
    assert phases == sorted(phases) and set(phases) == {0, 1, 2, 3, 4}
    for phase in (0, 1):
        deleted = [r["entity_id"] for r in ordered if r["phase"] == phase]
        assert deleted == sorted(deleted)

    lines = [json.loads(r["line"]) for r in envelope_lines(log).collect()]
    assert {x["topic"] for x in lines} == {contract.NODE_TOPIC, contract.EDGE_TOPIC, contract.METADATA_TOPIC}
    for x in lines:
        assert isinstance(x["key"], str) and x["value"]["schema_version"] == "1.0.0"
        assert x["value"]["event_time"].endswith("Z") and x["value"]["file_path"] == "a.py"
        if x["value"]["event_type"] == "edge_upsert":
            assert x["key"] == x["value"]["src_node_id"]
        if x["value"]["event_type"] == "node_delete":
            assert set(x["value"]) == {"schema_version", "event_time", "event_type", "file_path", "node_id"}
    meta = next(x["value"] for x in lines if x["topic"] == contract.METADATA_TOPIC)
    assert meta["parser"] == "python-ast" and meta["counts"]["nodes"] > 0 and meta["language"] == "python"
    definition = next(x["value"] for x in lines if x["value"].get("node_type") == "ClassDef" and x["value"]["name"] == "Entry")
    assert definition["properties"]["decorators"] == [] and definition["properties"]["qualified_name"] == "Store.Entry"

    # read back by file name and line, each key's events come in order
    out = fresh_path(spark, "lines")
    write_lines(log, out)
    files = spark.read.option("wholetext", "true").text(out).select("value", "_metadata.file_name").orderBy("file_name").collect()
    read_back = [json.loads(x) for f in files for x in f["value"].splitlines()]
    assert len(read_back) == len(lines)
    last = {}
    for x in read_back:
        at = (x["run_id"], x["phase"])
        assert at >= last.get((x["topic"], x["key"]), at)
        last[x["topic"], x["key"]] = at
    records = kafka_records(log).withColumn("task", F.spark_partition_id())
    assert records.groupBy("topic", "key").agg(F.count_distinct("task").alias("n")).filter("n > 1").count() == 0
    assert {h["key"] for h in records.first()["headers"]} == {"run_id", "phase"}
    discard(log)


def test_retention(spark):
    from codetide.sources.events import retained

    rows = [(t, f"2024-01-{d:02d}T00:00:00.000Z") for t in contract.RETENTION_DAYS for d in (1, 20, 30)]
    log = spark.createDataFrame(rows, "topic string, event_time string")
    kept = {tuple(r) for r in retained(log, F.lit("2024-01-31").cast("timestamp")).collect()}
    days = {t: sorted(int(e[8:10]) for x, e in kept if x == t) for t in contract.RETENTION_DAYS}
    assert days == {
        contract.NODE_TOPIC: [30], contract.EDGE_TOPIC: [30],
        contract.METADATA_TOPIC: [20, 30], contract.ERROR_TOPIC: [1, 20, 30],
    }
