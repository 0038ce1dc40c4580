"""Corpus scans, manifests, path rules, decoding."""

import json
import os

import pytest
from pyspark.sql import functions as F

from codetide import contract
from codetide.functions import ids, paths, symbols, text
from codetide.operators import discovery
from codetide.operators.checks import missing_topics
from codetide.sources.corpus import check_paths, first_files, list_corpus, one_file, read_corpus, read_files, read_manifest, read_manifest_table, restrict, select_files, write_manifest
from codetide.sources.events import bad_message_reason, decode


def column(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_corpus_scan_manifest_and_discovery(spark, tmp_path):
    marker = "# x\n" * 39 + "# DO NOT EDIT\n"
    late = "# x\n" * 40 + "# DO NOT EDIT\n"
    files = {
        "pkg/core.py": "x = 1\n", "pkg/tests/a.py": "", "test/b.py": "", "test_c.py": "", "pkg/d_test.py": "",
        "pkg/conftest.py": "", "setup.py": "", "pkg/_setup.py": "", "pkg/version.py": "", "pkg/_version.py": "",
        "pkg/p_pb2.py": "", "pkg/p_pb2_grpc.py": "", "pkg/_generated.py": "", "pkg/at40.py": marker, "pkg/at41.py": late,
        "pkg/returns.py": late.replace("\n", "\r"), "pkg/tests/setup.py": marker, "pkg/attest.py": "", "pkg/note.txt": "no",
        "pkg/bytes.py": b"# do not\xff edit\n",
    }
    for path, body in files.items():
        os.makedirs(os.path.dirname(tmp_path / "repo" / path), exist_ok=True)
        (tmp_path / "repo" / path).write_bytes(body if isinstance(body, bytes) else body.encode())
    corpus = read_corpus(spark, str(tmp_path / "repo"), "r")
    assert {r["file_path"] for r in corpus.collect()} == {p for p in files if p.endswith(".py")}
    assert bytes(one_file(corpus, "pkg/core.py").first()["content"]) == b"x = 1\n"

    classified = discovery.classify(corpus)
    kept = [r[0] for r in discovery.kept(classified).collect()]
    assert kept == ["pkg/at41.py", "pkg/attest.py", "pkg/core.py", "pkg/returns.py"]
    why = {r["file_path"]: r["exclude_reasons"] for r in discovery.excluded(classified).collect()}
    assert why["pkg/tests/setup.py"] == ["test", "setup", "auto-generated"]
    assert why["pkg/at40.py"] == why["pkg/bytes.py"] == ["auto-generated"]
    totals = discovery.summary(classified).first()
    assert (totals["total_files"], totals["kept_files"], totals["excluded_files"]) == (19, 4, 15)
    counts = {r["reason"]: r["files"] for r in discovery.reason_counts(classified).collect()}
    assert counts == {"test": 6, "setup": 3, "auto-generated": 8}

    manifest = tmp_path / "manifest.json"
    manifest.write_text(json.dumps({"summary": {"n": 2}, "kept_files": ["pkg/core.py", "pkg/attest.py", "a/../../x.py"]}, indent=1))
    listed = read_manifest(spark, str(manifest))
    assert [r["file_path"] for r in listed.orderBy("position").collect()][:2] == ["pkg/core.py", "pkg/attest.py"]
    assert [r["file_path"] for r in restrict(corpus, first_files(listed, 1)).collect()] == ["pkg/core.py"]
    problems = {r["file_path"]: r["path_error"] for r in check_paths(listed, "/srv/repo").collect()}
    assert problems == {"pkg/core.py": None, "pkg/attest.py": None, "a/../../x.py": "outside the root"}
    with pytest.raises(ValueError):
        first_files(listed, 0)
    for bad in ('{"kept_files": "a.py"}', '{"kept_files": [1, 2]}', '{"other": []}'):
        manifest.write_text(bad)
        with pytest.raises(ValueError):
            read_manifest(spark, str(manifest))


def test_manifest_as_a_table(spark, tmp_path):
    """Written by many tasks, of several repositories, chosen from before anything is read."""
    kept = spark.range(0, 300, 1, 5).select(
        F.when(F.col("id") % 2 == 0, "one").otherwise("two").alias("repository"), F.concat(F.lit("d/f"), "id", F.lit(".py")).alias("file_path"), F.lit(1).alias("other"))
    write_manifest(kept, str(tmp_path / "manifest"))
    manifest = read_manifest_table(spark, str(tmp_path / "manifest"))
    assert manifest.columns == ["repository", "file_path"] and manifest.count() == 300
    listing = spark.createDataFrame([("one", "d/f2.py", "/x", 1, None), ("two", "d/f2.py", "/y", 1, None)],
                                    "repository string, file_path string, path string, size long, modified timestamp")
    found = {(r["repository"], r["file_path"]): r["path"] for r in select_files(listing, manifest, "/").collect()}
    assert len(found) == 300 and found["one", "d/f2.py"] == "/x" and ("two", "d/f2.py") not in found
    with pytest.raises(ValueError):
        write_manifest(kept.select(F.lit(1).alias("file_path")), str(tmp_path / "bad"))
        read_manifest_table(spark, str(tmp_path / "bad"))
    write_manifest(kept.select(F.lit(None).cast("string").alias("file_path")), str(tmp_path / "none"))
    with pytest.raises(ValueError):
        read_manifest_table(spark, str(tmp_path / "none"))


def test_a_folder_of_any_size_is_listed_in_little_memory(tmp_path, monkeypatch):
    import gc
    import tracemalloc

    import pyarrow as pa

    from codetide.sources import corpus as source

    root = tmp_path / "flat"
    root.mkdir()
    (root / "below").mkdir()
    for i in range(40_000):
        os.close(os.open(f"{root}/a_rather_long_file_name_{i:06d}.{'py' if i % 4 else 'txt'}", os.O_CREAT))
    monkeypatch.setattr(source, "LISTED_AT_ONCE", 1000)
    monkeypatch.setattr(source, "LISTED_PER_TASK", 10)
    gc.collect()
    tracemalloc.start()
    files, folders = 0, []
    for batch in source._list(str(root), "r", ".py")(iter([pa.RecordBatch.from_pydict({"path": [str(root)]})])):
        files += batch.num_rows - batch.column(1).null_count
        folders += [p for p, f in zip(batch.column(2).to_pylist(), batch.column(1).to_pylist()) if f is None]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert files == 30_000 and folders == [f"{root}/below"]
    assert peak < 3 << 20  # one name in a list costs about a hundred bytes, thirty thousand of them more than that


def test_unreadable_files_become_read_errors(spark, tmp_path):
    from codetide.plans.extract import extract

    (tmp_path / "repo").mkdir()
    (tmp_path / "repo" / "__init__.py").write_text("x = 1\n")
    (tmp_path / "repo" / "gone.py").symlink_to(tmp_path / "nowhere.py")
    listing = list_corpus(spark, str(tmp_path / "repo"), "r")
    manifest = spark.createDataFrame([("__init__.py",), ("gone.py",), ("never.py",)], "file_path string")
    graph = extract(read_files(select_files(listing, manifest, str(tmp_path / "repo"))))
    assert [r["file_path"] for r in graph.metadata.collect()] == ["__init__.py"]
    errors = graph.errors.orderBy("file_path").collect()
    assert [(e["file_path"], e["stage"], e["error_type"], e["content_sha256"]) for e in errors] == [
        ("gone.py", "read_source", "FileNotFoundError", ""), ("never.py", "read_source", "FileNotFoundError", "")]


def test_choosing_before_reading(spark, tmp_path, monkeypatch):
    from codetide.sources import corpus as source

    monkeypatch.setattr(source, "LISTED_PER_TASK", 3)  # so that listing takes rounds
    root = tmp_path / "repo"
    for i in range(12):
        (root / f"d{i % 3}" / "e" / f"f{i % 2}").mkdir(parents=True, exist_ok=True)
        (root / f"d{i % 3}" / "e" / f"f{i % 2}" / f"m{i}.py").write_text("x" * i)
    listing = list_corpus(spark, str(root), "r")
    assert {(r["file_path"], r["size"]) for r in listing.collect()} == {(f"d{i % 3}/e/f{i % 2}/m{i}.py", i) for i in range(12)}

    # only the chosen file is opened: all others are no longer there
    chosen = read_files(one_file(listing, "d1/e/f1/m7.py"))
    for i in range(12):
        if i != 7:
            (root / f"d{i % 3}" / "e" / f"f{i % 2}" / f"m{i}.py").write_text("changed")
    rows = chosen.collect()
    assert [bytes(r["content"]) for r in rows] == [b"x" * 7]
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert plan.index("MapInArrow") < plan.index("Filter")  # the choice stands below the reader

    with pytest.raises(ValueError):
        select_files(listing, spark.createDataFrame([("../x.py",)], "file_path string"), str(root))


def test_paths(spark):
    given = ["a\\b.py", "./a//b.py", "a/../b.py", "/srv/repo/a.py", "../repo/a.py", "../x.py", "/etc/x.py", "a/../../repo2/x.py"]
    assert column(spark, given, paths.normalise(F.col("v")))[:3] == ["a/b.py", "a/b.py", "a/../b.py"]
    inside = column(spark, given, paths.stays_inside(F.col("v"), "/srv/repo"))
    assert inside == [True, True, True, True, True, False, False, False]
    assert column(spark, ["a.py", "a.PY", ".py", "d/.py", "apy", "a.pyc"], paths.is_source_path(F.col("v"))) == [
        True, True, False, False, False, False]


def test_text_facts(spark):
    bodies = ["", "a", "a\n", "a\nb", "a\r\nb\r\n", "\n", "é\n"]
    assert column(spark, bodies, text.line_count(F.col("v"))) == [0, 1, 1, 2, 2, 1, 1]
    assert column(spark, bodies, text.byte_count(F.col("v"))) == [len(b.encode()) for b in bodies]


def test_symbols(spark):
    pairs = [("f", "<module>"), ("f", "A.m"), ("self.g", "A.m"), ("self.g", "<module>"), ("cls.g.h", "A.B.m"), ("x.y.join", "A.m"), ("f()", "m.<lambda:3>")]
    df = spark.createDataFrame(pairs, "symbol string, scope string")
    got = [r[0] for r in df.select(symbols.call_candidates(F.col("symbol"), F.col("scope"))).collect()]
    assert got == [
        ["f", "f"], ["A.m.f", "A.f", "f", "f"], ["A.g", "g"], ["g"], ["A.B.g.h", "h"], ["x.y.join", "join"],
        ["m.<lambda:3>.f()", "m.f()", "f()", "f()"],
    ]


def test_ids_frame_their_parts(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc")], "x string, y string")
    assert df.select(ids.stable_hash("n", F.col("x"), F.col("y"))).distinct().count() == 2
    odd = ['quote " back \\ slash / [x]', "line\nbreak\ttab", "é \x7f", "", "[]"]
    import hashlib

    want = ["n:" + hashlib.sha256(json.dumps(["k", v, 3], ensure_ascii=False, separators=(",", ":")).encode()).hexdigest() for v in odd]
    assert column(spark, odd, ids.stable_hash("n", "k", F.col("v"), ids.Number(F.lit(3)))) == want


def test_decoding_and_reasons(spark):
    good = '{"file_path":"a.py","loc":3,"size_bytes":9,"counts":{"nodes":1,"extra":2},"unknown":[1]}'
    messages = [good, '{"file_path":"b.py","loc":"many"}', "{broken", '{"loc":1}', "[1]", None]
    df = spark.createDataFrame([(m,) for m in messages], "value string")
    rows = decode(df.withColumn("raw", F.col("value")), contract.METADATA_SCHEMA)
    got = [(r["file_path"], r["loc"]) for r in rows.collect()]
    assert got[:4] == [("a.py", 3), ("b.py", None), (None, None), (None, 1)]
    reasons = [r[0] for r in rows.select(bad_message_reason(F.col("raw"), F.col("file_path"))).collect()]
    assert reasons == [None, None, "malformed", "missing key", "missing key", "malformed"]


def test_routes_and_topics(spark):
    kinds = list(contract.ROUTES) + ["other"]
    topics = column(spark, kinds, contract.topic_of(F.col("v")))
    assert topics == [contract.ROUTES[k][0] for k in kinds[:-1]] + [None]
    df = spark.createDataFrame([("edge_delete", "f", None, "e1"), ("edge_delete", "f", "n1", "e1")],
                               "event_type string, file_path string, src_node_id string, edge_id string")
    assert [r[0] for r in df.select(contract.key_of(F.col("event_type"), otherwise="edge_id")).collect()] == ["e1", "n1"]
    log = spark.createDataFrame([("a",), ("a",)], "topic string")
    expected = spark.createDataFrame([("a",), ("b",)], "topic string")
    assert {tuple(r) for r in missing_topics(expected, log).collect()} == {("a", True), ("b", False)}
