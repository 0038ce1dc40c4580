"""Edges and counts of files whose key is their own: no ids on the way, the same results."""

import pathlib

import pyarrow.parquet as pq

from codetide.operators import fold
from codetide.operators.edges import count_by_type
from codetide.operators.syntax import FILE
from codetide.plans.extract import extract, file_counts
from codetide.plans.increment import run
from codetide.session import StagingArea
from codetide.sources.state import StateTables

BODIES = {
    "loop.py": "def h(n):\n    for i in range(n):\n        if i > 3:\n            break\n        n += i\n    else:\n        n = -n\n    return n\nh(h(2))\nprint(h)\n",
    "try.py": "import os.path as p, sys\nclass C:\n    def m(self, a):\n        try:\n            self.m(a)\n        except ValueError as e:\n            raise e\n        finally:\n            print(p, sys)\n        return lambda z: z + a\n",
    "empty.py": "",
    "bad.py": "def broken(:\n",
}
NAMES = ["edges", "ast_child_edges", "cfg_edges", "dfg_edges", "call_edges"]


def _columns(folder: str) -> list[str]:
    return pq.read_schema(next(pathlib.Path(folder.removeprefix("file:")).rglob("*.parquet"))).names


def test_counts_without_ids_are_those_of_the_graph(corpus):
    files = corpus(BODIES)
    counted = {r["file_path"]: [r["nodes"], *[r[n] for n in NAMES]] for r in file_counts(files).collect()}
    graph = extract(files)
    edges = {r["file_path"]: [r[n] for n in NAMES] for r in count_by_type(graph.edges, FILE).collect()}
    nodes = {r["file_path"]: r["count"] for r in graph.nodes.groupBy("file_path").count().collect()}
    said = {r["file_path"]: [r["counts"][n] for n in ("nodes", *NAMES)] for r in graph.metadata.collect()}
    want = {name: [n, *edges.get(name, [0] * len(NAMES))] for name, n in nodes.items()}
    assert counted == want == said and set(want) == {"loop.py", "try.py", "empty.py"}
    assert want["loop.py"][4] > 0 and want["try.py"][5] > 0


def test_staged_tables_hold_no_ids(spark, corpus):
    area = StagingArea(spark)
    extract(corpus(BODIES), area=area)
    kept = {p.name.split("-", 1)[1]: p for p in pathlib.Path(area.root.removeprefix("file:")).iterdir()}
    assert "edges" not in kept
    assert not {"node_id", "parent_id"} & set(_columns(str(kept["rows"])))


def test_stored_log_holds_an_id_once(spark, corpus, tmp_path):
    state, log = StateTables(spark, f"{tmp_path}/state"), f"{tmp_path}/log"
    run(corpus(BODIES), state, log, 1)
    second = run(corpus({**BODIES, "loop.py": "def h(n):\n    return n\n"}), state, log, 2).log
    assert not {"entity_id", "key"} & set(_columns(f"{log}/run_id=1"))
    gone = second.filter("event_type = 'edge_delete'").select("key", "entity_id", "edge.edge_id", "edge.src_node_id", "event_time").collect()
    assert gone and all(r["entity_id"] == r["edge_id"] and r["key"] == r["src_node_id"] for r in gone)
    times = {r["event_time"] for r in second.select("event_time").distinct().collect()}
    assert len(times) == 1 and {r["event_time"] for r in gone} == times
    nodes = second.filter("event_type = 'node_upsert'")
    assert nodes.filter("entity_id != node.node_id or key != file_path").isEmpty() and not nodes.isEmpty()


def test_keys_that_files_share_are_as_before(corpus):
    one = corpus({"a.py": "x = 1\nprint(x)\n", "b.py": "y = 2\n"})
    twice = extract(one.union(corpus({"a.py": "x = 1\nprint(x)\n"})))
    # places of both files meet: four edges for each one that a single file has, but for uses, which follow each other
    assert {r["file_path"]: r["n"] for r in twice.edges.filter("edge_type = 'CFG'").groupBy("file_path").agg({"*": "count"}).withColumnRenamed("count(1)", "n").collect()} == {"a.py": 4}
    assert {(r["file_path"], r["counts"]["cfg_edges"]) for r in twice.metadata.collect()} == {("a.py", 4), ("b.py", 0)}


def test_rare_duplicates(spark):
    rows = spark.createDataFrame([("a",), ("b",), ("a",), ("c",), ("a",)], "id string")
    assert [tuple(r) for r in fold.rare_duplicates(rows, ["id"]).collect()] == [("a", 3)]
    assert fold.rare_duplicates(rows.distinct(), ["id"]).isEmpty()
