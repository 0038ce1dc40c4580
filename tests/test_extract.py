"""The extractor against the plain-Python model, and the laws of its ids."""

import ast
import hashlib
import io
import json
import pathlib
from collections import Counter

import pytest

import argparse
import codecs
import contextlib
import dataclasses
import json.decoder
import textwrap

from codetide.operators import checks, fold
from codetide.operators.flatten import file_rows
from codetide.operators.syntax import FILE
from codetide.plans.extract import extract
from tests.model import Model

SAMPLE = """\
import os
from shutil import rmtree as wipe


def parts(path):
    while path:
        path, tail = os.path.split(path)
        if not tail:
            break
        yield tail


class Store:
    class Entry:
        limit = 8

        def open(self, name, *, mode="r"):
            try:
                handle = os.open(name, 0)
            except OSError as gone:
                raise LookupError(name) from gone
            finally:
                self.limit -= 1
            return handle

    def clear(self, root):
        for name in parts(root):
            wipe(name)
        return self.Entry().open(root)
"""

LINES = {"sample.py": 29}

# ids of the first node of each kind and scope in SAMPLE, as they must stay
KNOWN_IDS = {
    ("Module", "<module>"): "n:5283281652f80b7dccdfd9154068984daec65871b0b7791d0520ece4992060c7",
    ("alias", "<module>"): "n:23814e28732d1e31df340217b0648efafb55021f7b39854a8a3eac939837373e",
    ("FunctionDef", "<module>"): "n:1c157b8dcb7a5c9762b557f366abd46838dc3377fc818209300f2dfd60f49627",
    ("ClassDef", "<module>"): "n:f298a91ab742e552841bdc753668e5d379487cb6db823a19cbc96993670e1dce",
    ("arg", "parts"): "n:c65d8046e7c9059c9fa4a5dc4007520aab80a7ccf6ea4a85ce5e5df47a03b24c",
    ("While", "parts"): "n:0081fa10ddc79303594553d2a9f7795d0438d83a8d89d14c443609b60118c5e5",
    ("Name", "parts"): "n:e6a821c2b5c10561ee0cc39f934a51356f731341090ba6a1819470335aa448a6",
    ("Attribute", "parts"): "n:afbec3f233678bef74b45ede1902f2c45dfddd3c9525ee937512f58022de8338",
    ("Call", "parts"): "n:97de0e54d463ca99014a75bbe33f6749d2aa60965fbc60aad34e6761f995e021",
    ("Constant", "Store.Entry"): "n:f56ab66a5b7b510b054a011e03c0c3e8057de847587a0d9e676dec7fd103dc56",
    ("ExceptHandler", "Store.Entry.open"): "n:ef29916bdf4e7a2a8d0b641dae874c032adaa5ba1f1f03b8b70b6dc91df50e7f",
    ("For", "Store.clear"): "n:16e208a57928c6082f1974cd72e42d00883bc8f7a7562b255163cbeb629e9245",
}

SHAPES = {
    "branches.py": """
def f(a):
    while a:
        if a > 1:
            if a > 2:
                break
        elif a:
            continue
    else:
        a = 1
    for i in a:
        for j in i:
            if j: break
        else:
            break
        continue
    if a: pass
""",
    "tries.py": """
def f(a):
    try:
        x = a
    except A: x = 1
    try:
        return a
    finally:
        x = 2
    try:
        x
    except (A, B) as e:
        raise e
    except C:
        pass
    else:
        y = x
    for k in a:
        try:
            continue
        except D:
            break
        finally:
            x = k
    try:
        x
    except* E:
        y = 3
    match a:
        case {"k": v} if x:
            z = v
            def inner(q=z):
                return q
        case _:
            pass
    async def g():
        async for t in a:
            async with t as (u, w):
                await u
        else:
            return w
    return z
""",
    "flow.py": """
import os.path, sys as system
from a import b as c, d
@d
class K(c):
    size: int = 3
    total = size
    @property
    def m(self, n=size, *args, k: system = os, **kw):
        n += k
        n: int = n
        out = [n for n in args if n]
        (w := out)
        del out
        return w, out, lambda n=n: n + self.size
    m2 = m
def m(a, /, b, *, c): return a + b + c
x = K.m
x = x + 1; x += x
for i, (p, *q) in x: p, q, i
with x as x, x as y: x
def r(): return r()
r = r
""",
    "calls.py": """
def a(): return a()
class B:
    def a(self): return self.a() + cls.b() + a()
    def b(self):
        def a(): return self.missing()
        return a(), self.c()()
    c = lambda self: self.b()
def twice(): pass
def twice(): pass
twice(); x.twice(); x.y[0].B(); x().y; f()(); [1][0](); (lambda: 0)(); "".join(x); B.b(); B().b()
class C:
    class D:
        def e(self): return D(), C.D(), self.e(), e()
""",
    "empty.py": "",
    "no_newline.py": "x = 1",
    "windows.py": "x = 1\r\ny = x\r\n",
    "text.py": 'é = "naïve \\u2028 \\\\ / \'"\nprint(é, b"\\x00", 1e400, 3j, None, ..., "%s" % ("x" * 1),\n f"{é!r:>{10}}")\n' + 'z = "' + "long" * 80 + '"\n',
}

LIBRARY = [argparse, codecs, contextlib, dataclasses, json.decoder, textwrap]


def sources() -> dict[str, str]:
    library = {m.__name__ + ".py": pathlib.Path(m.__file__).read_text() for m in LIBRARY}
    return {"sample.py": SAMPLE, **SHAPES, **library}


@pytest.fixture(scope="module")
def graph(spark):
    rows = [("example/repo", path, bytearray(body.encode())) for path, body in sources().items()]
    df = spark.createDataFrame(rows, "repository string, file_path string, content binary")
    out = extract(df)
    nodes = {r["node_id"]: r for r in out.nodes.collect()}
    edges = out.edges.collect()
    return out, nodes, edges


def place(node):
    return (node["node_type"], node["start_line"], node["start_col"])


def found(graph, edge_type, label):
    _, nodes, edges = graph
    out = {}
    for e in edges:
        if e["edge_type"] == edge_type:
            row = label(e, nodes)
            out.setdefault(e["file_path"], Counter())[row] += 1
    return out


@pytest.mark.parametrize("edge_type", ["CFG", "DFG", "CALL"])
def test_edges_match_the_model(graph, edge_type):
    if edge_type == "CFG":
        got = found(graph, "CFG", lambda e, n: (place(n[e["src_node_id"]]), e["properties"]["branch"], place(n[e["dst_node_id"]])))
        want = {p: Counter(Model(s).cfg()) for p, s in sources().items()}
    elif edge_type == "DFG":
        # the anchor is not stored, but an aug: edge is the one that ends in a stored name
        def label(e, n):
            end = n[e["dst_node_id"]]
            aug = end["properties"]["context"] == "Store"
            return (place(n[e["src_node_id"]]), ("aug:" if aug else "") + e["properties"]["variable"], place(end))

        got = found(graph, "DFG", label)
        want = {p: Counter(Model(s).dfg()) for p, s in sources().items()}
    else:
        got = found(graph, "CALL", lambda e, n: (
            place(n[e["src_node_id"]]), e["properties"]["target"],
            place(n[e["properties"]["call_site_node_id"]]), place(n[e["dst_node_id"]])))
        want = {p: Counter(Model(s).calls()) for p, s in sources().items()}
    for path in sources():
        assert got.get(path, Counter()) == want[path], path


def test_syntax_nodes_and_child_edges(graph):
    _, nodes, edges = graph
    for path, source in sources().items():
        want = Counter(type(n).__name__ for n in ast.walk(ast.parse(source)))
        got = Counter(n["node_type"] for n in nodes.values() if n["file_path"] == path)
        got.pop("ExternalSymbol", None)
        assert got == want, path
    children = [e for e in edges if e["edge_type"] == "AST_CHILD"]
    assert len({e["dst_node_id"] for e in children}) == len(children)
    for e in children:
        assert nodes[e["src_node_id"]]["file_path"] == nodes[e["dst_node_id"]]["file_path"] == e["file_path"]


def test_ids_are_the_hash_of_their_parts(graph):
    """A few literal ids; others from their parts, with the standard library."""
    _, nodes, edges = graph
    digest = lambda prefix, *parts: f"{prefix}:" + hashlib.sha256(
        json.dumps(parts, ensure_ascii=False, separators=(",", ":")).encode()).hexdigest()
    for (kind, scope), node_id in KNOWN_IDS.items():
        assert (nodes[node_id]["node_type"], nodes[node_id]["scope"]) == (kind, scope)
    # repeats of one name in one scope are numbered
    own = lambda *parts: digest("n", "example/repo", "sample.py", *parts)
    assert own("parts", "Name", "tail:Load", 0) in nodes and own("parts", "Name", "tail:Load", 1) in nodes
    assert own("parts", "Name", "tail:Load", 2) not in nodes
    broken = digest("ast", "Break()")
    assert own("parts", "Break", broken, 0) in nodes
    for n in nodes.values():
        if n["node_type"] == "ExternalSymbol":
            assert n["node_id"] == digest("n", "example/repo", n["file_path"], "external-symbol", n["name"])
    for e in edges:
        if e["edge_type"] == "CALL":
            assert e["edge_id"] == digest(
                "e", "CALL", e["src_node_id"], e["dst_node_id"], e["properties"]["call_site_node_id"])


def test_shape_text_equals_the_standard_dump():
    from codetide.operators.flatten import _Walk

    for source in sources().values():
        tree = ast.parse(source, type_comments=True)
        walk = _Walk()
        text = walk.visit(tree)
        assert text == ast.dump(tree, show_empty=True)


def test_properties(graph):
    _, nodes, _ = graph
    by = {(n["file_path"], n["node_type"], n["name"]): n for n in nodes.values()}
    m = by["flow.py", "FunctionDef", "m"]
    method = by["sample.py", "FunctionDef", "open"]
    assert method["properties"]["qualified_name"] == "Store.Entry.open" and method["properties"]["decorators"] == []
    assert by["flow.py", "ClassDef", "K"]["properties"]["decorators"] == ["d"]
    assert m["properties"]["language"] == "python"
    assert by["sample.py", "Module", "module"]["scope"] == "<module>"
    long = [n for n in nodes.values() if n["file_path"] == "text.py" and (n["properties"]["value_preview"] or "").startswith("'long")]
    assert len(long) == 1 and len(long[0]["properties"]["value_preview"]) == 160
    outside = by["sample.py", "ExternalSymbol", "LookupError"]
    assert outside["properties"]["resolved"] is False and outside["scope"] == "<external>"


def test_metadata_and_invariants(graph):
    out, nodes, edges = graph
    meta = {r["file_path"]: r for r in out.metadata.collect()}
    for path, source in sources().items():
        row, body = meta[path], source.encode()
        assert row["size_bytes"] == len(body)
        assert row["content_sha256"] == hashlib.sha256(body).hexdigest()
        assert row["loc"] == LINES.get(path, len(io.StringIO(source).readlines()))
        assert row["counts"]["nodes"] == sum(n["file_path"] == path for n in nodes.values())
        assert row["counts"]["edges"] == sum(e["file_path"] == path for e in edges)
    assert checks.tree_invariant(out.nodes, out.edges, FILE).filter("not holds").count() == 0
    assert checks.cross_view(out.metadata, out.edges, FILE).count() == 0
    assert fold.duplicates(out.nodes, ["node_id"]).count() == 0
    assert fold.duplicates(out.edges, ["edge_id"]).count() == 0


def test_line_shift_keeps_ids_except_inside_lambdas(corpus):
    def ids_of(body):
        out = extract(corpus({"a.py": body}))
        return {r[0] for r in out.nodes.select("node_id").collect()}, {r[0] for r in out.edges.select("edge_id").collect()}

    assert ids_of(SAMPLE) == ids_of("\n\n" + SAMPLE)
    with_lambda = SAMPLE + "f = lambda v: v\n"
    assert ids_of(with_lambda)[0] != ids_of("\n\n" + with_lambda)[0]


def test_bad_files_become_error_rows(corpus):
    files = {
        "syntax.py": "def broken(:\n",
        "bytes.py": b"\xff",
        "mark.py": b"\xef\xbb\xbfx = 1\n",
        "nul.py": "x = 1\x00\n",
        "deep.py": "x = " + "-" * 20000 + "1\n",
        "huge.py": "x = 0x" + "f" * 6000 + "\n",
        "good.py": SAMPLE,
    }
    out = extract(corpus(files))
    errors = {r["file_path"]: r for r in out.errors.collect()}
    assert sorted(errors) == sorted(set(files) - {"good.py"})
    stages = {p: e["stage"] for p, e in errors.items()}
    assert stages["syntax.py"] == "ast_parse" and stages["bytes.py"] == "decode"
    assert stages["mark.py"] == stages["nul.py"] == "ast_parse"
    assert stages["deep.py"] == stages["huge.py"] == "parser_service"
    row = errors["bytes.py"]
    digest = hashlib.sha256(b"\xff").hexdigest()
    parts = ["example/repo", "bytes.py", digest, "decode", row["error_type"], row["error_message"]]
    want = hashlib.sha256(json.dumps(parts, separators=(",", ":")).encode()).hexdigest()
    assert row["error_id"] == f"err:{want}" and row["severity"] == "error"
    assert {r[0] for r in out.nodes.select("file_path").distinct().collect()} == {"good.py"}


def test_a_tree_may_be_as_deep_as_the_parser_allows():
    rows = file_rows("deep.py", ("x = " + " + ".join(f"a{i}" for i in range(4000)) + "\n").encode())
    kinds = Counter(r["kind"] for r in rows)
    assert kinds["BinOp"] == kinds["Add"] == 3999 and kinds["Load"] == 4000 and kinds["Name"] == 4001
    assert max(r["pos"] for r in rows) == len(rows) - 1 == 16_001


def test_one_file_never_raises():
    assert file_rows("a.py", b"def broken(:")[0]["error"]["type"] == "SyntaxError"
