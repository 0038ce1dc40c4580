"""The message log: places, offsets, dead letters and their way back, ageing, archived input, snapshots by bucket."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from codetide import contract
from codetide.session import fresh_path
from codetide.sources.events import open_envelopes, read_landed, read_landing, sweep
from codetide.sources.files import tree
from codetide.sources.state import StateTables
from codetide.streaming.log import MessageLog, judged, start_log
from codetide.streaming.views import DocumentSnapshots, GraphSnapshots

NODE, META = contract.NODE_TOPIC, contract.METADATA_TOPIC


@pytest.fixture
def root(spark):
    return fresh_path(spark, "test-log")


def node(number, **more):
    return {"node_id": f"n:{number}", "event_type": "node_upsert", "file_path": f"f{number % 5}", **more}


def line(value, topic=NODE, key=None, **more):
    value = value if isinstance(value, str) else json.dumps(value)
    return json.dumps({"topic": topic, "key": key or "k", **more, "value": value})


def land(spark, root, drop, files):
    """Files of lines, written as they stand."""
    for name, lines in files.items():
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/landing/drop={drop}/{name}")
        out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
        out.write(bytearray("".join(x + "\n" for x in lines).encode()))
        out.close()


def drain(spark, root, log, **options):
    query = start_log(open_envelopes(read_landing(spark, f"{root}/landing", **options)), log, f"{root}/checkpoint", once=True)
    query.awaitTermination()
    return [p["batchId"] for p in query.recentProgress if p["numInputRows"]]


def test_letters_name_file_and_line(spark, root, monkeypatch):
    lines = [line(node(n)) if n % 7 else line({"event_type": "node_upsert", "n": n}) for n in range(300)]
    lines[20], lines[21] = "", "no json"
    # blocks far smaller than the file, so that its lines are read by several tasks
    for key, size in (("spark.sql.files.maxPartitionBytes", "4k"), ("spark.sql.files.openCostInBytes", "1")):
        spark.conf.set(key, size)
    try:
        land(spark, root, 1, {"a.txt": lines, "b c.txt": lines[:50]})
        log = MessageLog(spark, f"{root}/log")
        drain(spark, root, log)
        assert log.pieces().select("source", "block").distinct().count() > 5
        letters = log.dead_letters().collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    bad = [n for n in range(300) if n % 7 == 0 or n in (20, 21)]
    found = {(r["source"].rsplit("/", 1)[1], r["line"]): r for r in letters}
    assert set(found) == {("a.txt", n + 1) for n in bad} | {("b%20c.txt", n + 1) for n in bad if n < 50}
    assert all(json.loads(r["value"])["n"] == r["line"] - 1 for r in letters if r["reason"] == "missing node_id")
    assert {r["reason"] for r in letters if r["line"] in (21, 22)} == {"no topic"}
    assert all(r["arrived"] is not None and r["batch_id"] == 0 for r in letters)
    assert len({r["letter"] for r in letters}) == len(letters)


def test_letters_without_a_file(spark, root):
    log = MessageLog(spark, f"{root}/log")
    rows = [(NODE, "a", "{", "broker/0", 17), (NODE, "b", "{", None, None), (NODE, "b", "{", None, None)]
    messages = spark.createDataFrame(rows, "topic string, key string, value string, source string, source_offset bigint")
    log.write_batch(judged(messages), 4)
    letters = log.dead_letters().collect()
    assert len({r["letter"] for r in letters}) == 3 and {r["source_offset"] for r in letters} == {17, None}


def test_a_letter_comes_back_once(spark, root):
    land(spark, root, 1, {"a.txt": [line(node(1)), line({"n": 2}), line({"n": 3}), line("{")]})
    log = MessageLog(spark, f"{root}/log")
    drain(spark, root, log)
    letters = log.dead_letters()
    mended = letters.filter("reason = 'missing node_id'").select(
        "letter", F.col("source_topic").alias("topic"), "key",
        F.to_json(F.struct(F.concat(F.lit("n:"), F.get_json_object("value", "$.n")).alias("node_id"))).alias("value"),
    )
    assert log.redrive(mended.unionAll(mended), f"{root}/landing", 1) > 0
    # the same call again, before and after the lines are consumed
    assert log.redrive(mended, f"{root}/landing", 1) == 0
    drain(spark, root, log)
    assert log.redrive(mended, f"{root}/landing", 1) == 0
    log.redrive(mended, f"{root}/landing", 2)
    drain(spark, root, log)
    nodes = sorted(json.loads(r["value"])["node_id"] for r in log.read([NODE]).collect())
    assert nodes == ["n:1", "n:2", "n:3"]
    assert [r["reason"] for r in log.dead_letters(open_only=True).collect()] == ["malformed"]
    assert log.dead_letters().count() == 3


def test_a_redrive_that_died_goes_on(spark, root, monkeypatch):
    land(spark, root, 1, {"a.txt": [line({"n": n}) for n in range(40)]})
    log = MessageLog(spark, f"{root}/log")
    drain(spark, root, log)
    mended = log.dead_letters().select(
        "letter", F.col("source_topic").alias("topic"), "key", F.to_json(F.struct(F.col("line").cast("string").alias("node_id"))).alias("value")
    ).repartition(4)
    import codetide.streaming.log as module

    real, calls = module.move, []

    def dying(session, folder, to):
        calls.append(folder)
        if len(calls) == 1:
            one = sorted(p for p in tree(session, folder))[0]
            from codetide.sources.files import rename

            rename(session, one, f"{to}/{one.rsplit('/', 1)[1]}")
            raise OSError("died in between")
        return real(session, folder, to)

    monkeypatch.setattr(module, "move", dying)
    with pytest.raises(OSError, match="died"):
        log.redrive(mended, f"{root}/landing", 1)
    drain(spark, root, log)
    log.redrive(mended, f"{root}/landing", 1)
    drain(spark, root, log)
    assert sorted(int(json.loads(r["value"])["node_id"]) for r in log.read([NODE]).collect()) == list(range(1, 41))


def offsets_of(log):
    return {(r["batch_id"], r["topic"], r["partition"]): (r["first_offset"], r["last_offset"], r["messages"]) for r in log.offsets().collect()}


def test_offsets_are_dense_and_stay_when_a_batch_is_repeated(spark, root):
    rows = [line(node(n, event_time=f"2024-01-{1 + n % 3:02d}T00:00:00.000Z"), key=f"k{n % 11}", topic=NODE if n % 4 else META) for n in range(200)]
    log = MessageLog(spark, f"{root}/log")
    land(spark, root, 1, {"a.txt": rows[:90], "b.txt": rows[90:120]})
    drain(spark, root, log)
    land(spark, root, 2, {"a.txt": [x for x in rows[120:] if NODE in x]})
    drain(spark, root, log)
    before = offsets_of(log)
    placed = lambda: {(r["batch_id"], r["topic"], r["partition"], r["offset"]): (r["value"], r["line"]) for r in log.placed(log.read()).collect()}
    whole = placed()
    assert len(whole) == log.read().count()
    for (_, topic, partition), (first, last, messages) in before.items():
        assert last - first + 1 == messages
        mine = sorted(o for _, t, p, o in whole if (t, p) == (topic, partition))
        assert mine == list(range(len(mine)))
    # offsets of a second batch go on from the first
    assert all(before[0, t, p][1] + 1 == first for (b, t, p), (first, _, _) in before.items() if b == 1 and (0, t, p) in before)
    # written again, read in other blocks: every message keeps its offset
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        log.write_batch(judged(open_envelopes(read_landed(spark, f"{root}/landing/drop=1"))), 0)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert offsets_of(log) == before and placed() == whole
    # a partition that rested in a batch goes on where it was
    land(spark, root, 3, {"a.txt": [line(node(1), topic=META, key="k0")] * 3})
    drain(spark, root, log)
    part = next((t, p) for b, t, p in offsets_of(log) if b == 2)
    assert offsets_of(log)[2, *part][0] == 1 + max((v[1] for (b, t, p), v in before.items() if (t, p) == part), default=-1)


def test_days_go_whole_and_nothing_is_rewritten(spark, root):
    days = ["2024-01-01", "2024-01-09", "2024-01-10", "2024-01-20"]
    log = MessageLog(spark, f"{root}/log")
    for drop in (1, 2):
        times = [f"{d}T0{drop}:00:00.000Z" for d in days]
        land(spark, root, drop, {"a.txt": [line(node(n, event_time=t), topic=topic) for n, t in enumerate(times) for topic in (NODE, "other")] + [line(node(9))]})
        drain(spark, root, log)
    files = set(tree(spark, f"{root}/log/messages"))
    now = datetime.datetime(2024, 1, 17, 12)  # the window of seven days begins at noon of the tenth
    gone = log.expire_days(now, {NODE: 7}, up_to_batch=0)
    assert gone == [(0, NODE, datetime.date(2024, 1, 1)), (0, NODE, datetime.date(2024, 1, 9))]
    assert log.expire_days(now, {NODE: 7}) == [(1, NODE, datetime.date(2024, 1, 1)), (1, NODE, datetime.date(2024, 1, 9))]
    assert log.expire_days(now, {NODE: 7}) == []
    left = set(tree(spark, f"{root}/log/messages"))
    assert left < files and all(f"topic={NODE}/day=2024-01-0" in f for f in files - left)
    rows = log.read().groupBy("topic", "day").count().collect()
    assert {(r["topic"], str(r["day"])): r["count"] for r in rows} == {
        **{("other", d): 2 for d in days}, (NODE, "2024-01-10"): 2, (NODE, "2024-01-20"): 2, (NODE, "None"): 2}


def test_consumed_files_move_to_the_archive(spark, root):
    log = MessageLog(spark, f"{root}/log")
    archive = f"{root}/archive"
    for drop in (1, 2, 3):
        land(spark, root, drop, {"a.txt": [line(node(drop))], "b c%.txt": [line(node(drop + 10))]})
        assert drain(spark, root, log, archive=archive) == [drop - 1]
    assert drain(spark, root, log, archive=archive) == []
    # a file that has not been consumed stays
    land(spark, root, 4, {"new.txt": [line(node(4))]})
    sweep(spark, f"{root}/landing", archive, log.pieces())
    assert [p.rsplit("/", 1)[1] for p in tree(spark, f"{root}/landing")] == ["new.txt"]
    assert len(tree(spark, archive)) == 6
    assert drain(spark, root, log, archive=archive) == [3]
    assert sorted(json.loads(r["value"])["node_id"] for r in log.read().collect()) == sorted(f"n:{n}" for n in (1, 2, 3, 4, 11, 12, 13))


def test_a_compaction_leaves_other_buckets_alone(spark, root):
    log = MessageLog(spark, f"{root}/log")
    snapshots = GraphSnapshots(spark, f"{root}/graph", buckets=8)
    documents = DocumentSnapshots(spark, f"{root}/documents", buckets=8)

    def drop(number, numbers):
        order = {"run_id": number, "phase": 2}
        nodes = [line(node(n, name=f"at {number}"), **order) for n in numbers]
        metas = [line({"file_path": f"f{n}", "event_type": "source_upsert", "loc": number}, topic=META, **order) for n in numbers]
        land(spark, root, number, {"a.txt": nodes + metas})
        drain(spark, root, log)

    drop(0, range(100))
    assert len(snapshots.compact(log, 0)["nodes"]) == 8 and len(documents.compact(log, 0)["documents"]) == 8
    first = set(tree(spark, f"{root}/graph/nodes")) | set(tree(spark, f"{root}/documents/documents"))
    drop(1, [3])
    touched, doc = snapshots.compact(log, 1), documents.compact(log, 1)
    assert len(touched["nodes"]) == 1 and touched["edges"] == [] and len(doc["documents"]) == 1
    now = set(tree(spark, f"{root}/graph/nodes")) | set(tree(spark, f"{root}/documents/documents"))
    assert first < now and all("/at=1/" in p for p in now - first) and len({p.rsplit("/", 1)[0] for p in now - first}) == 2
    # what the new files stand for can go, nothing else
    gone = snapshots.vacuum() + documents.vacuum()
    assert sorted(g.split("/at=0/")[1] for g in gone) == sorted([f"bucket={touched['nodes'][0]}", f"bucket={doc['documents'][0]}"])
    drop(2, [3, 4, 200])
    snapshots.compact(log, 2)
    assert snapshots.compact(log, 2) == {} and snapshots.latest() == 2
    drop(3, [5])
    names = {r["node_id"]: r["name"] for r in snapshots.view(log)[0].collect()}
    expected = {f"n:{n}": "at 0" for n in range(100)} | {"n:3": "at 2", "n:4": "at 2", "n:200": "at 2", "n:5": "at 3"}
    assert names == expected
    assert {r["_id"]: r["loc"] for r in documents.view(log).collect()} == {k.replace("n:", "f"): int(v[3:]) for k, v in expected.items()}
    # once compacted, the batches are not needed
    snapshots.compact(log, 3)
    log.expire(3)
    assert {r["node_id"]: r["name"] for r in snapshots.view(log)[0].collect()} == expected
    assert GraphSnapshots(spark, f"{root}/graph", buckets=99).buckets == 8


def test_state_is_compacted_by_bucket(spark, root):
    state = StateTables(spark, f"{root}/state", buckets=4)

    def commit(run, paths):
        key = "repository string, file_path string"
        rows = [("r", p, f"{p} {run}") for p in paths]
        nodes = spark.createDataFrame(rows, f"{key}, node_id string")
        edges = spark.createDataFrame([(*r, "s") for r in rows], f"{key}, edge_id string, src_node_id string")
        state.commit(run, spark.createDataFrame(rows, f"{key}, content_sha256 string"), nodes, edges)

    current = lambda: {r["file_path"]: r["node_id"] for r in state.ids("nodes").collect()}
    paths = [f"p{n}" for n in range(30)]
    commit(1, paths)
    assert state.compact(2) == [] and state.committed_runs() == [1]
    commit(3, ["p1"])
    expected = {p: f"{p} 1" for p in paths} | {"p1": "p1 3"}
    before = set(tree(spark, f"{root}/state/nodes"))
    (bucket,) = state.compact(4)
    new = set(tree(spark, f"{root}/state/nodes")) - before
    assert {p.rsplit("/", 2)[1] for p in new} == {f"bucket={bucket}"} and current() == expected
    assert state.committed_runs() == [1, 3, 4]  # other buckets still begin with the first run
    gone = state.vacuum()
    assert gone and all(f"bucket={bucket}" in g for g in gone) and current() == expected
    commit(5, paths[:20])
    expected |= {p: f"{p} 5" for p in paths[:20]}
    assert current() == expected and len(state.compact(6)) == 4
    assert state.committed_runs() == [6] and current() == expected
    assert {r["content_sha256"] for r in state.files().collect()} == set(expected.values())
