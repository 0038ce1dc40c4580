"""Log and state hold what ids are made of; whoever reads them gets the ids."""

import pathlib

import pyarrow.dataset as ds
from pyspark.sql import functions as F

from codetide.functions import ids
from codetide.operators.edges import all_edges, local_counts
from codetide.operators.syntax import FILE
from codetide.plans.extract import extract, parsed_rows
from codetide.plans.increment import read_log, run
from codetide.sources.state import StateTables

BODIES = {
    "loop.py": "def h(n):\n    for i in range(n):\n        if i > 3:\n            break\n        n += i\n    return h(n)\nprint(h(2))\n",
    "same.py": "class C:\n    def m(self, a):\n        return self.m(a)\nC().m(1)\n",
    "bad.py": "def broken(:\n",
}


def _odd(corpus):
    """A key of its own, one that two files share, one with a null, and a file that is no Python."""
    again = corpus({"same.py": BODIES["same.py"] + "x = C\n"})
    return corpus(BODIES).unionByName(again).unionByName(corpus({"none.py": "y = 1\nprint(y)\n"}, None))


def _rows(df):
    return sorted(map(repr, df.collect()))


def test_edges_of_staged_parts_are_those_of_ids(corpus):
    files = _odd(corpus)
    graph, rows = extract(files), parsed_rows(files)
    assert _rows(graph.edges) == _rows(all_edges(rows).select(*graph.edges.columns))
    said = {r["file_path"]: r["counts"] for r in graph.metadata.collect()}
    own = {r["file_path"]: r for r in local_counts(rows.filter("file_path = 'loop.py'")).collect()}
    assert all(said["loop.py"][n] == own["loop.py"][n] for n in said["loop.py"].asDict())


def test_log_and_state_hold_no_ids_and_give_them_back(spark, corpus, tmp_path):
    state, log = StateTables(spark, f"{tmp_path}/state"), f"{tmp_path}/log"
    first = run(_odd(corpus), state, log, 1)
    nodes = {r[0] for r in first.log.filter("event_type = 'node_upsert'").select("entity_id").collect()}
    edges = {r[0] for r in first.log.filter("event_type = 'edge_upsert'").select("entity_id").collect()}
    stored = [ds.dataset([str(p) for p in pathlib.Path(t).rglob("*.parquet")]) for t in (f"{tmp_path}/state/nodes", f"{tmp_path}/state/edges")]
    assert all(t.count_rows() and t.count_rows(ds.field(name).is_valid()) == 0 for t, name in zip(stored, ("node_id", "edge_id")))
    kept = {p.name for p in pathlib.Path(f"{log}/run_id=1").iterdir()}
    assert {"rows", "flows", "externals", "metadata"} <= kept and "topic=cpg.edge.events" not in kept
    # a file whose key holds a null has no state, as before
    named = first.log.filter("repository is not null")
    for what, table in (("node", "nodes"), ("edge", "edges")):
        upserts = named.filter(F.col("event_type") == f"{what}_upsert").select(*FILE, F.col("entity_id").alias(f"{what}_id"))
        assert _rows(upserts) == _rows(state.ids(table).select(*FILE, f"{what}_id"))
    assert nodes and edges and _rows(first.log) == _rows(read_log(spark, log, 1))

    second = run(corpus({**BODIES, "loop.py": "print(1)\n"}), state, log, 2)
    gone = {r[0] for r in second.log.filter("event_type in ('node_delete', 'edge_delete')").select("entity_id").collect()}
    assert gone and gone <= nodes | edges
    was = _rows(second.log)
    second.release()
    assert was == _rows(second.log) == _rows(read_log(spark, log, 2))
    # compaction goes on with ids that are made and ids that are given
    given = spark.createDataFrame([("r", "given.py", "n:1", "e:1", "n:1", "0")], "repository string, file_path string, node_id string, edge_id string, src_node_id string, content_sha256 string")
    state.commit(3, given, given, given)
    before = {t: _rows(state.ids(t)) for t in ("nodes", "edges")}
    state.compact(4)
    assert before == {t: _rows(state.ids(t)) for t in ("nodes", "edges")} and any("n:1" in r for r in before["edges"])


def test_packed_ids(spark):
    real = "n:" + "0123456789abcdef" * 4
    odd = [real, "e" + real[1:], real.upper(), real + "0", real[:-1], real + "\n", "n:", "", "\0", "é:" + real[2:], "00" * 33, None]
    rows = spark.createDataFrame([(t,) for t in odd], "id string").withColumn("short", ids.packed(F.col("id")))
    found = rows.select("id", ids.unpacked(F.col("short")).alias("back"), F.octet_length("short").alias("n"), "short").collect()
    assert all(r["id"] == r["back"] for r in found) and len({r["short"] and bytes(r["short"]) for r in found}) == len(odd)
    assert found[0]["n"] == 33
