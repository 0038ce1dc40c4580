"""Folds against a sequential interpreter, on random histories in random order."""

import random

import pytest
from pyspark.sql import functions as F

from codetide.operators import fold

NODES = [f"n{i}" for i in range(6)]
ORDER = ["seq"]


def history(rng, length):
    """Random node and edge events over a few ids, some of unknown type."""
    events = []
    for seq in range(length):
        if rng.random() < 0.5:
            kind = rng.choice(["node_upsert", "node_upsert", "node_delete", "other", None])
            props = {k: rng.choice(["1", "2", None]) for k in rng.sample(["a", "b", "c"], rng.randint(0, 3))}
            events.append(("node", seq, kind, rng.choice(NODES), None, None, None, rng.choice(["f", None]), props))
        else:
            src, dst = rng.choice(NODES), rng.choice(NODES)
            kind = rng.choice(["edge_upsert", "edge_upsert", "edge_delete", "other"])
            events.append(("edge", seq, kind, None, f"{src}>{dst}", src, dst, None, None))
    return events


def interpret(events):
    """One event after the other, as a graph store would apply them."""
    nodes, props, edges = {}, {}, {}
    for what, seq, kind, node, edge, src, dst, name, new in sorted(events, key=lambda e: e[1]):
        if what == "node":
            if kind == "node_upsert":
                nodes[node] = (name, seq)
                for k, v in new.items():
                    if v is None:
                        props.get(node, {}).pop(k, None)
                    else:
                        props.setdefault(node, {})[k] = v
            else:
                nodes.pop(node, None)
                props.pop(node, None)
                for e in [e for e, (s, d, _) in edges.items() if node in (s, d)]:
                    del edges[e]
        elif kind == "edge_upsert":
            for end in (src, dst):
                nodes.setdefault(end, None)
            edges[edge] = (src, dst, seq)
        else:
            edges.pop(edge, None)
    return nodes, {(n, k, v) for n, p in props.items() for k, v in p.items()}, edges


def frames(spark, events):
    schema = ("h int, what string, seq int, event_type string, node_id string, edge_id string, src_node_id string, "
              "dst_node_id string, name string, properties map<string,string>")
    df = spark.createDataFrame(events, schema)
    # one table holds many histories: their ids are kept apart by a prefix
    tag = lambda c: F.concat(F.col("h").cast("string"), F.lit("/"), c)
    df = df.withColumns({c: tag(c) for c in ("node_id", "edge_id", "src_node_id", "dst_node_id")})
    time = F.col("seq").cast("string").alias("event_time")
    empty = F.lit(None)
    nodes = df.filter("what = 'node'").select(
        "seq", "event_type", time, "node_id", empty.cast("string").alias("node_type"), "name",
        F.lit("p").alias("file_path"), F.lit("s").alias("scope"),
        *[F.lit(1).alias(c) for c in ("start_line", "end_line", "start_col", "end_col")], "properties")
    edges = df.filter("what = 'edge'").select(
        "seq", "event_type", time, "edge_id", F.lit("CALL").alias("edge_type"), "src_node_id", "dst_node_id",
        F.lit("p").alias("file_path"))
    return nodes, edges


def views(spark, nodes, edges):
    state = fold.node_accumulators(nodes, edges, ORDER)
    got_nodes = {r["node_id"]: None if r["is_stub"] else (r["name"], int(r["updated_at"])) for r in fold.node_view(state).collect()}
    deletes = fold.node_deletes(nodes, ORDER)
    assert {tuple(r) for r in deletes.collect()} == {tuple(r) for r in fold.accumulated_deletes(state).collect()}
    got_edges = {r["edge_id"]: (r["src_node_id"], r["dst_node_id"], int(r["updated_at"]))
                 for r in fold.edge_view(fold.edge_accumulators(edges, ORDER), deletes).collect()}
    props = fold.live_properties(fold.property_accumulators(nodes, ORDER), deletes)
    return got_nodes, {tuple(r) for r in props.collect()}, got_edges


def test_folds_match_the_interpreter_in_any_order(spark):
    rng = random.Random(7)
    rows, want_nodes, want_props, want_edges = [], {}, set(), {}
    for h in range(300):
        events = history(rng, rng.randint(1, 40))
        nodes, props, edges = interpret(events)
        want_nodes.update({f"{h}/{n}": v for n, v in nodes.items()})
        want_props |= {(f"{h}/{n}", k, v) for n, k, v in props}
        want_edges.update({f"{h}/{e}": (f"{h}/{s}", f"{h}/{d}", q) for e, (s, d, q) in edges.items()})
        rows += [(h, *e) for e in events]
    rng.shuffle(rows)
    assert views(spark, *frames(spark, rows)) == (want_nodes, want_props, want_edges)
    # at-least-once delivery: repeats change nothing
    again = rows + rng.sample(rows, len(rows) // 2)
    assert views(spark, *frames(spark, again)) == (want_nodes, want_props, want_edges)


def test_accumulators_merge_to_the_same_state(spark):
    rng = random.Random(11)
    rows = [(h, *e) for h in range(60) for e in history(rng, 30)]
    nodes, edges = frames(spark, rows)
    rng.shuffle(rows)
    parts = [frames(spark, rows[:700]), frames(spark, rows[700:])]
    merged = fold.merge_node_accumulators(
        fold.node_accumulators(*parts[0], ORDER).unionByName(fold.node_accumulators(*parts[1], ORDER)))
    whole = fold.node_accumulators(nodes, edges, ORDER)
    assert {tuple(r) for r in merged.collect()} == {tuple(r) for r in whole.collect()}
    merged = fold.merge_edge_accumulators(
        fold.edge_accumulators(parts[0][1], ORDER).unionByName(fold.edge_accumulators(parts[1][1], ORDER)))
    assert {tuple(r) for r in merged.collect()} == {tuple(r) for r in fold.edge_accumulators(edges, ORDER).collect()}


def test_documents_are_replaced_whole(spark):
    stored = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "_id string, n int, t string")
    arrived = spark.createDataFrame([("b", 5, None, 1), ("b", 6, None, 2), ("c", 7, "z", 1)], "_id string, n int, t string, at int")
    got = fold.replace_documents(stored, arrived, "_id", ["at"], ["n", "t"])
    assert {tuple(r) for r in got.collect()} == {("a", 1, "x"), ("b", 6, None), ("c", 7, "z")}
    once = fold.replace_documents(None, arrived, "_id", ["at"], ["n", "t"])
    twice = fold.replace_documents(once, arrived, "_id", ["at"], ["n", "t"])
    assert {tuple(r) for r in once.collect()} == {tuple(r) for r in twice.collect()}


@pytest.mark.parametrize(("pieces", "batch"), [(1, 10_000), (7, 13), (60, 512)])
def test_hot_keys_are_carried_across_pieces(spark, pieces, batch):
    """A key with most of the rows, ties on time, keys and values that are null, and values that must cross pieces and batches."""
    from codetide.operators.carry import carry

    rng = random.Random(3)
    key = lambda: rng.choice([None, "hot", "hot", "hot", "hot", f"k{rng.randint(1, 40)}"])
    rows = [(key(), rng.randint(0, 3), rng.randint(0, 50), i, rng.choice([None, None, None, f"v{i}"])) for i in range(4000)]
    rows = [(k, p if k != "hot" else 1, ts, i, v) for k, p, ts, i, v in rows]
    df = spark.createDataFrame(rows, "k string, p int, ts int, id int, v string")
    values = {"near": F.col("v"), "pair": F.when(F.col("id") % 17 == 0, F.struct("id", "v"))}
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        for forward in (True, False):
            found = carry(df, ["k", "p"], ["ts", "id"], values, forward, pieces).collect()
            got = {r["id"]: (r["near"], r["pair"] and tuple(r["pair"])) for r in found}
            want, last, pairs = {}, {}, {}
            for k, p, ts, i, v in sorted(rows, key=lambda r: (r[2], r[3]), reverse=not forward):
                want[i] = last.get((k, p)), pairs.get((k, p))
                if v is not None:
                    last[k, p] = v
                if i % 17 == 0:
                    pairs[k, p] = (i, v)
            assert got == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_carrying_shuffles_whole_rows_once(spark):
    from codetide.operators.carry import carry

    df = spark.range(1000).select(F.col("id"), (F.col("id") % 7).alias("k"))
    plan = carry(df, ["k"], ["id"], {"near": F.col("id")})._jdf.queryExecution().executedPlan().toString()
    # the staged rows are joined to one row per key and piece: the only window is over those
    assert "rangepartitioning" not in plan and plan.count("+- Window [") == 1
