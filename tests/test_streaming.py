"""Checkpointed resume, replay, dead letters, and the streamed graph of a real corpus."""

import pytest
from pyspark.sql import functions as F

from codetide import contract
from codetide.operators import fold
from codetide.operators.changelog import edge_events, node_events
from codetide.plans.increment import run
from codetide.session import fresh_path
from codetide.sources.events import open_envelopes, read_landing, write_lines
from codetide.sources.state import StateTables
from codetide.streaming.views import DocumentSnapshots, GraphSnapshots, MessageLog, document_rows, document_view, start_log, stop
from tests.test_extract import SAMPLE
from tests.test_increment import AT, EDITED

ORDER = ["run_id", "phase"]


def land(log, root, number):
    write_lines(log, f"{root}/landing/{number}")


def drain(spark, root, log, **options):
    messages = open_envelopes(read_landing(spark, f"{root}/landing", **options))
    query = start_log(messages, log, f"{root}/checkpoint", once=True)
    query.awaitTermination()
    return [(p["batchId"], p["numInputRows"]) for p in query.recentProgress if p["numInputRows"]]


@pytest.fixture
def root(spark):
    return fresh_path(spark, "test-stream")


def test_views_follow_the_corpus_through_restarts(spark, corpus, root):
    state = StateTables(spark, f"{root}/state")
    log = MessageLog(spark, f"{root}/messages")
    snapshots = GraphSnapshots(spark, f"{root}/snapshots", ORDER)

    first = run(corpus({"a.py": SAMPLE, "b.py": "x = 1\n"}), state, f"{root}/log", 1, event_time=AT).log
    land(first, root, 1)
    assert drain(spark, root, log) == [(0, first.count())]
    assert drain(spark, root, log) == []  # a restart without input runs no batch
    snapshots.compact(log, 0)
    documents = DocumentSnapshots(spark, f"{root}/documents", ["batch_id", *ORDER])
    documents.compact(log, 0)

    second = run(corpus({"a.py": EDITED, "b.py": "x = 1\n"}), state, f"{root}/log", 2, skip_unchanged=True, event_time=AT).log
    land(second, root, 2)
    assert drain(spark, root, log) == [(1, second.count())]
    assert log.dead_letters().count() == 0

    # documents: one more message, still one document per file
    meta = log.read([contract.METADATA_TOPIC])
    assert meta.filter("batch_id = 1").count() == 1
    docs = document_view(document_rows(meta), ["batch_id", "run_id", "phase"], ["loc", "counts"])
    assert {r["_id"]: r["loc"] for r in docs.collect()} == {"a.py": 29, "b.py": 1}

    stored = documents.view(log).collect()
    assert {r["_id"]: r["loc"] for r in stored} == {"a.py": 29, "b.py": 1}
    assert {r["_id"]: r["content_sha256"] for r in stored} == {
        r["file_path"]: r["content_sha256"] for r in state.files().collect()}

    # graph: snapshot plus newer batch = fold of everything = current state
    nodes, edges, props = snapshots.view(log)
    whole = first.unionByName(second)
    all_nodes, all_edges = fold.graph_view(node_events(whole), edge_events(whole), ORDER)
    same = lambda a, b: {tuple(r) for r in a.collect()} == {tuple(r) for r in b.select(*a.columns).collect()}
    assert same(nodes, all_nodes) and same(edges, all_edges)
    assert {r[0] for r in nodes.select("node_id").collect()} == {r["node_id"] for r in state.ids("nodes").collect()}
    assert {r[0] for r in edges.select("edge_id").collect()} == {r["edge_id"] for r in state.ids("edges").collect()}
    some = props.filter("property = 'qualified_name'").select("value")
    assert {r[0] for r in some.collect()} == {"parts", "Store", "Store.Entry", "Store.Entry.open", "Store.purge"}
    snapshots.compact(log, 1)
    assert snapshots.latest() == 1
    again_nodes, again_edges, _ = snapshots.view(log)
    assert same(again_nodes, all_nodes) and same(again_edges, all_edges)

    # what a snapshot covers can go
    kept_before = {tuple(r) for r in snapshots.view(log)[0].collect()}
    assert log.expire(0) == [0] and log.expire(0) == []
    assert {r["batch_id"] for r in log.read().select("batch_id").distinct().collect()} == {1}
    assert {tuple(r) for r in snapshots.view(log)[0].collect()} == kept_before

    # a batch written twice leaves one copy
    before = log.read().count()
    batch = log.read().filter("batch_id = 1").withColumn("topic", F.col("source_topic"))
    kept = spark.createDataFrame(batch.collect(), batch.schema)
    log.write_batch(kept, 1)
    assert log.read().count() == before

    # the same messages delivered again as a new batch change no view
    land(first, root, 3)
    drain(spark, root, log)
    nodes, edges, _ = snapshots.view(log)
    assert same(nodes, all_nodes) and same(edges, all_edges)


def test_bad_messages_become_dead_letters(spark, root):
    lines = [
        '{"topic":"cpg.node.events","key":"a","value":{"node_id":"n:1","event_type":"node_upsert"}}',
        '{"topic":"cpg.node.events","key":"a","value":{"event_type":"node_upsert"}}',
        '{"topic":"cpg.edge.events","key":"a","value":"{oops"}',
        '{"topic":"cpg.edge.events","key":"a","value":{"edge_id":"e:1","event_type":"edge_upsert","src_node_id":"n:1"}}',
        '{"topic":"cpg.edge.events","key":"a","value":{"edge_id":"e:1","event_type":"edge_delete"}}',
        "not json",
    ]
    spark.createDataFrame([(x,) for x in lines], "line string").coalesce(1).write.text(f"{root}/landing/1")
    log = MessageLog(spark, f"{root}/messages")
    drain(spark, root, log)
    assert sorted(r["reason"] for r in log.dead_letters().collect()) == ["malformed", "missing dst_node_id", "missing node_id", "no topic"]
    assert log.read([contract.NODE_TOPIC]).count() == 1


def test_capture(spark, root):
    from codetide.sources.events import capture

    spark.createDataFrame([("{}",)], "line string").write.text(f"{root}/landing/1")
    capture(read_landing(spark, f"{root}/landing"), "captured").awaitTermination()
    assert [r["value"] for r in spark.table("captured").collect()] == ["{}"]


def test_a_running_query_stops_and_resumes(spark, root):
    row = '{"topic":"cpg.node.events","key":"a","value":{"node_id":"n:1"}}'
    spark.createDataFrame([(row,)], "line string").write.text(f"{root}/landing/1")
    log = MessageLog(spark, f"{root}/messages")
    query = start_log(open_envelopes(read_landing(spark, f"{root}/landing")), log, f"{root}/checkpoint", interval="1 second", name="kept")
    query.processAllAvailable()
    stop(query)
    assert not query.isActive and log.read().count() == 1
    spark.createDataFrame([(row,)], "line string").write.text(f"{root}/landing/2")
    messages = open_envelopes(read_landing(spark, f"{root}/landing"))
    start_log(messages, log, f"{root}/checkpoint", once=True).awaitTermination()
    assert sorted(r["batch_id"] for r in log.read().collect()) == [0, 1]
