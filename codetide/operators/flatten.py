"""Source files to one row per syntax visit: the only place rows meet Python.

The grammar is the standard library's; this helper just writes down what a
pre-order walk sees (kind, names, positions, ancestry).  Ids, edges, flow and
calls are all derived from these rows by joins, windows and aggregates.
"""

from __future__ import annotations

import ast
import hashlib
import itertools
import json
import operator
import sys
import time
import warnings
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from codetide.functions.ids import content_sha256
from codetide.functions.text import byte_count, line_count

# fixed values: characters of a constant's repr that are kept, and that tell it from others
PREVIEW_WIDTH, SIGNATURE_WIDTH = 160, 120
BATCH_ROWS = 16_384

_S, _I = T.StringType(), T.IntegerType()
# An enclosing block: its role (kind and field of its owner) and the owner's own place.
BLOCK = T.StructType(
    [
        T.StructField("role", _S),
        T.StructField("pos", _I),
        T.StructField("parent_pos", _I),
        T.StructField("field", _S),
        T.StructField("idx", _I),
        T.StructField("is_last", T.BooleanType()),
        T.StructField("has_else", T.BooleanType()),
        T.StructField("has_final", T.BooleanType()),
    ]
)
SCHEMA = T.StructType(
    [
        T.StructField("repository", _S),
        T.StructField("file_path", _S),
        T.StructField("pos", _I),
        T.StructField("parent_pos", _I),
        T.StructField("parent_kind", _S),
        T.StructField("field", _S),
        T.StructField("idx", _I),
        T.StructField("kind", _S),
        T.StructField("ident", _S),
        T.StructField("asname", _S),
        T.StructField("ctx", _S),
        T.StructField("shape_hash", _S),
        # running number among visits of the same scope, kind and signature
        T.StructField("occurrence", _I),
        # what the parent's id is made of, but for its kind: no parent has a constant's signature
        T.StructField("parent_scope", _S),
        T.StructField("parent_ident", _S),
        T.StructField("parent_shape_hash", _S),
        T.StructField("parent_occurrence", _I),
        T.StructField("value_type", _S),
        T.StructField("value_preview", _S),
        T.StructField("decorators", T.ArrayType(_S)),
        T.StructField("callee", _S),
        T.StructField(
            "imports",
            T.ArrayType(T.StructType([T.StructField("name", _S), T.StructField("asname", _S)])),
        ),
        T.StructField("scope", _S),
        # nearest function, lambda or module; a class does not change it
        T.StructField("owner_pos", _I),
        # the statement an expression belongs to (null below a lambda), the scope that
        # runs it, and whether it is outside handler and match-case bodies
        T.StructField("stmt_pos", _I),
        T.StructField("flow_scope_pos", _I),
        T.StructField("flow_ok", T.BooleanType()),
        # statements and handlers: place in the block, blocks of its own, and the enclosing
        # blocks up to the running scope, innermost first
        T.StructField("is_last", T.BooleanType()),
        T.StructField("has_else", T.BooleanType()),
        T.StructField("has_final", T.BooleanType()),
        T.StructField("path", T.ArrayType(BLOCK)),
        T.StructField("start_line", _I),
        T.StructField("end_line", _I),
        T.StructField("start_col", _I),
        T.StructField("end_col", _I),
        # facts about the file, on its first row only
        T.StructField("content_sha256", _S),
        T.StructField("loc", _I),
        T.StructField("size_bytes", T.LongType()),
        T.StructField("parse_duration_ms", T.DoubleType()),
        T.StructField("n_visits", _I),
        # set on the single row of a file that could not be read
        T.StructField(
            "error",
            T.StructType(
                [
                    T.StructField("type", _S),
                    T.StructField("message", _S),
                    T.StructField("classes", T.ArrayType(_S)),
                ]
            ),
        ),
    ]
)
# Executors get this one module inside the task, so they need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# every row has every column, in this order: a batch of rows is turned into columns as it stands
_BLANK = dict.fromkeys(SCHEMA.names)
_FIELDLESS: dict[str, str] = {}  # hashes of kinds without fields, such as Load()
_DEFS = (ast.FunctionDef, ast.AsyncFunctionDef, ast.ClassDef)
_FUNCTIONS = (ast.FunctionDef, ast.AsyncFunctionDef, ast.Lambda)


def _shape_hash(shape: str) -> str:
    """The id rule of the library for one text part."""
    known = _FIELDLESS.get(shape)
    if known is None:
        framed = f"[{json.dumps(shape, ensure_ascii=False)}]"
        known = "ast:" + hashlib.sha256(framed.encode("utf-8")).hexdigest()
        if shape.endswith("()") and shape[:-2].isidentifier():
            _FIELDLESS[shape] = known
    return known


def dotted_name(expr: ast.AST) -> str:
    """Readable name of an expression: ``a.b``, ``f()``, ``x`` for ``x[0]``, else empty."""
    suffixes: list[str] = []
    while True:
        match expr:
            case ast.Attribute(value=inner, attr=attr):
                suffixes.append(f".{attr}")
            case ast.Call(func=inner):
                suffixes.append("()")
            case ast.Subscript(value=inner):
                pass
            case ast.Name(id=name):
                break
            case _:
                name = ""
                break
        expr = inner
    for suffix in reversed(suffixes):
        if name:
            name += suffix
        else:
            name = "<call-result>" if suffix == "()" else suffix[1:]
    return name


class _Kind:
    """What a walk has to know about a syntax class, looked up once per class."""

    def __init__(self, of: type) -> None:
        self.name = of.__name__
        self.is_stmt = issubclass(of, ast.stmt)
        self.in_block = issubclass(of, (ast.stmt, ast.ExceptHandler))
        self.is_def = issubclass(of, _DEFS)
        self.is_lambda = issubclass(of, ast.Lambda)
        self.is_owner = issubclass(of, (*_FUNCTIONS, ast.Module))
        self.is_scope = issubclass(of, (*_DEFS, ast.Module))
        self.has_place = "lineno" in of._attributes
        self.is_shaped = of not in (ast.Constant, ast.Module)
        # fields, and whether a dump leaves them out when they are None
        self.fields = [(name, getattr(of, name, ...) is None) for name in of._fields]
        self.is_leaf = not of._fields and not self.is_stmt
        self.identify = next((f for c, f in _IDENTITIES.items() if issubclass(of, c)), None)


def _of_def(node, row: dict) -> None:
    row["ident"] = node.name
    row["decorators"] = [dotted_name(d) for d in node.decorator_list]


def _of_name(node, row: dict) -> None:
    row["ident"], row["ctx"] = node.id, type(node.ctx).__name__


def _of_arg(node, row: dict) -> None:
    row["ident"] = node.arg


def _of_attribute(node, row: dict) -> None:
    row["ident"] = node.attr


def _of_alias(node, row: dict) -> None:
    row["ident"], row["asname"] = node.name, node.asname


def _of_constant(node, row: dict) -> None:
    row["value_type"] = type(node.value).__name__
    row["value_preview"] = repr(node.value)[:PREVIEW_WIDTH]


def _of_call(node, row: dict) -> None:
    row["callee"] = dotted_name(node.func)


def _of_import(node, row: dict) -> None:
    row["imports"] = [{"name": a.name, "asname": a.asname} for a in node.names]


_IDENTITIES = {
    _DEFS: _of_def, ast.Name: _of_name, ast.arg: _of_arg, ast.Attribute: _of_attribute, ast.alias: _of_alias,
    ast.Constant: _of_constant, ast.Call: _of_call, (ast.Import, ast.ImportFrom): _of_import,
}
_KINDS: dict[type, _Kind] = {}


def _kind(node: ast.AST) -> _Kind:
    known = _KINDS.get(type(node))
    if known is None:
        known = _KINDS[type(node)] = _Kind(type(node))
    return known


class _Walk:
    """Pre-order rows of one file; shape texts are built bottom-up on the way back.

    Visits are generators on a list of their own, so a tree may be as deep as the
    parser accepts it.  ``blank`` is a row with what all rows of the file have.
    Where no ids are wanted, ``shaped`` is off: shape texts are neither joined nor hashed.
    """

    def __init__(self, blank: dict = _BLANK, shaped: bool = True) -> None:
        self.rows: list[dict] = []
        self.blank = blank
        self.shaped = shaped

    def visit(self, node) -> str:
        """Rows of a whole tree; its shape text."""
        open_visits, text = [self._visit(node, None, None, None, True, "<module>", None, (None, None, False), (None, ()))], None
        while open_visits:
            try:
                open_visits.append(open_visits[-1].send(text))
                text = None
            except StopIteration as over:
                open_visits.pop()
                text = over.value
        return text

    def _leaf(self, kind, parent, field, idx, scope, owner, stmt) -> str:
        """Contexts and operators: a quarter of all visits, with nothing below them."""
        shape = f"{kind.name}()"
        row = self.blank.copy()
        row["pos"] = len(self.rows)
        row["parent_pos"] = parent
        row["parent_kind"] = self.rows[parent]["kind"]
        row["field"], row["idx"] = field, idx
        row["kind"], row["scope"], row["owner_pos"] = kind.name, scope, owner
        row["stmt_pos"], row["flow_scope_pos"], row["flow_ok"] = stmt
        if self.shaped:
            row["shape_hash"] = _shape_hash(shape)
        self.rows.append(row)
        return shape

    def _visit(self, node, parent, field, idx, is_last, scope, owner, stmt, block):
        """``stmt`` = (pos, scope pos, ok) for expressions; ``block`` = (scope pos, path).

        Yields the visits of children and is sent their shape texts; returns its own.
        """
        pos, kind = len(self.rows), _kind(node)
        if kind.is_stmt:
            ok = not any(b["role"].startswith(("ExceptHandler", "match_case")) for b in block[1])
            stmt = (pos, block[0], ok)
        row = self.blank.copy()
        row["pos"], row["parent_pos"] = pos, parent
        if parent is not None:
            row["parent_kind"] = self.rows[parent]["kind"]
        row["field"], row["idx"] = field, idx
        row["kind"], row["scope"] = kind.name, scope
        row["stmt_pos"], row["flow_scope_pos"], row["flow_ok"] = stmt
        if kind.has_place:
            row["start_line"], row["end_line"] = node.lineno, node.end_lineno
            row["start_col"], row["end_col"] = node.col_offset, node.end_col_offset
        self.rows.append(row)
        if kind.in_block:
            row["is_last"] = is_last
            row["has_else"] = bool(getattr(node, "orelse", None))
            row["has_final"] = bool(getattr(node, "finalbody", None))
            row["path"] = block[1]
        if kind.is_owner:
            owner = pos
        row["owner_pos"] = owner
        if kind.identify is not None:
            kind.identify(node, row)

        below = scope
        if kind.is_def:
            below = node.name if scope == "<module>" else f"{scope}.{node.name}"
        elif kind.is_lambda:
            label = f"<lambda:{node.lineno}>"
            below = label if scope == "<module>" else f"{scope}.{label}"
            stmt = (None, None, False)

        parts = []
        for name, optional in kind.fields:
            value = getattr(node, name, None)
            if value is None:
                if optional:
                    continue
                text = "None"
            elif isinstance(value, ast.AST):
                child = _kind(value)
                if child.is_leaf:
                    text = self._leaf(child, pos, name, None, below, owner, stmt)
                else:
                    text = yield self._visit(value, pos, name, None, True, below, owner, stmt, block)
            elif isinstance(value, list):
                inner = self._enter(kind, row, name, value, block)
                end, texts = len(value) - 1, []
                for i, item in enumerate(value):
                    if not isinstance(item, ast.AST):
                        texts.append(repr(item))
                        continue
                    child = _kind(item)
                    if child.is_leaf:
                        texts.append(self._leaf(child, pos, name, i, below, owner, stmt))
                    else:
                        texts.append((yield self._visit(item, pos, name, i, i == end, below, owner, stmt, inner)))
                text = f"[{', '.join(texts)}]"
            else:
                text = repr(value)
            parts.append(f"{name}={text}")
        if not self.shaped:
            return ""
        shape = f"{kind.name}({', '.join(parts)})"
        if row["ident"] is None and kind.is_shaped:
            row["shape_hash"] = _shape_hash(shape)
        return shape

    @staticmethod
    def _enter(kind: _Kind, row: dict, field: str, items: list, block: tuple) -> tuple:
        """The block context of a list field: a new scope, one block deeper, or unchanged."""
        if kind.is_scope:
            return (row["pos"], ())
        if not items or not isinstance(items[0], (ast.stmt, ast.ExceptHandler, ast.match_case)):
            return block
        names = ("pos", "parent_pos", "field", "idx", "is_last", "has_else", "has_final")
        return (block[0], ({"role": f"{kind.name}.{field}", **{n: row[n] for n in names}}, *block[1]))


def number_repeats(rows: list[dict]) -> None:
    """Count visits that look alike, in visiting order.

    All rows of a file are at hand here and in order, so numbering them now saves
    shuffling the whole flattened corpus for a window.
    """
    seen: dict[tuple, int] = {}
    for row in rows:
        preview = row["value_preview"]
        like = (
            row["scope"],
            row["kind"],
            row["ident"],
            row["asname"],
            row["ctx"],
            row["value_type"],
            preview and preview[:SIGNATURE_WIDTH],
            row["shape_hash"],
        )
        row["occurrence"] = seen[like] = seen.get(like, -1) + 1


def name_parents(rows: list[dict]) -> None:
    """What each parent's id is made of, beside its child: so no row has to look its parent up."""
    for row in rows:
        if row["parent_pos"] is not None:
            parent = rows[row["parent_pos"]]
            row["parent_scope"], row["parent_ident"] = parent["scope"], parent["ident"]
            row["parent_shape_hash"], row["parent_occurrence"] = parent["shape_hash"], parent["occurrence"]


def file_rows(file_path: str, content: bytes, blank: dict = _BLANK, identified: bool = True) -> list[dict]:
    """Rows of one file, or one error row; a bad file never raises.  What only ids need is left out unless ``identified``."""
    started = time.perf_counter()
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            tree = ast.parse(content.decode("utf-8"), filename=file_path, type_comments=True)
        walk = _Walk(blank, identified)
        walk.visit(tree)
        walk.rows[0]["parse_duration_ms"] = round((time.perf_counter() - started) * 1000, 3)
        walk.rows[0]["n_visits"] = len(walk.rows)
        if identified:
            number_repeats(walk.rows)
            name_parents(walk.rows)
        return walk.rows
    except Exception as error:  # noqa: BLE001 - any failure becomes a row
        classes = [c.__name__ for c in type(error).__mro__]
        message = str(error).encode("utf-8", "backslashreplace").decode("utf-8")
        return [{**blank, "error": {"type": type(error).__name__, "message": message, "classes": classes}}]


def _paths(paths: tuple, kind: pa.DataType) -> pa.Array:
    """Enclosing blocks of each row, from one flat list of blocks: far cheaper than row by row."""
    ends = list(itertools.accumulate(0 if path is None else len(path) for path in paths))
    offsets = pa.array([0, *ends], pa.int32())
    blocks = [block for path in paths if path for block in path]
    columns = zip(*[block.values() for block in blocks]) if blocks else [()] * len(kind.value_type)
    children = [pa.array(c, f.type) for c, f in zip(columns, kind.value_type)]
    flat = pa.StructArray.from_arrays(children, fields=list(kind.value_type))
    return pa.ListArray.from_arrays(offsets, flat, type=kind, mask=pa.array([path is None for path in paths]))


# what no consumer needs unless it wants ids
ID_PARTS = ("shape_hash", "occurrence", "parent_scope", "parent_ident", "parent_shape_hash", "parent_occurrence")
Test = Callable[[dict], bool]


def _flatten_batches(
    batches: Iterator[pa.RecordBatch], wanted: T.StructType = SCHEMA, keep: Test | None = None
) -> Iterator[pa.RecordBatch]:
    schema = to_arrow_schema(wanted)
    identified = any(part in schema.names for part in ID_PARTS)
    values = dict.values if wanted == SCHEMA else operator.itemgetter(*schema.names)

    def pack(rows: list[dict]) -> pa.RecordBatch:
        columns = zip(*map(values, rows))
        arrays = [_paths(c, t) if n == "path" else pa.array(c, type=t) for n, t, c in zip(schema.names, schema.types, columns)]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    pending: list[dict] = []
    for batch in batches:
        names = batch.schema.names
        # one file's content at a time becomes a Python object
        for i in range(batch.num_rows):
            facts = {name: column[i].as_py() for name, column in zip(names, batch.columns)}
            content, unread = facts.pop("content"), facts.pop("read_error")
            blank = {**_BLANK, "repository": facts["repository"], "file_path": facts["file_path"]}
            if unread is not None:
                rows = [{**blank, "error": {**unread, "classes": [unread["type"], "OSError"]}}]
            else:
                rows = file_rows(facts["file_path"], content if content is not None else b"", blank, identified)
            rows[0].update(facts)
            pending += rows if keep is None else filter(keep, rows)
            if len(pending) >= BATCH_ROWS:
                yield pack(pending)
                pending = []
    if pending:
        yield pack(pending)


def flatten(
    corpus: DataFrame, spread: int | None = None, columns: list[str] | None = None, keep: Test | None = None
) -> DataFrame:
    """One row per syntax visit of every file of ``corpus(repository, file_path, content)``.

    A ``read_error(type, message)`` column, where there is one, marks files without content.

    Hashes and sizes are taken in the JVM before the rows cross over.  ``spread``
    shuffles the (small, unparsed) contents into that many tasks first; leave it
    out when the scan already gives enough.  ``columns`` and ``keep``, a test of a row, say
    what is wanted: what else there is does not leave Python.
    """
    unread = F.col("read_error") if "read_error" in corpus.columns else F.lit(None)
    files = corpus.select(
        unread.cast("struct<type string, message string>").alias("read_error"),
        "repository",
        "file_path",
        F.col("content").cast("binary").alias("content"),
        content_sha256(F.col("content")).alias("content_sha256"),
        line_count(F.col("content")).alias("loc"),
        byte_count(F.col("content")).alias("size_bytes"),
    )
    if spread:
        files = files.repartition(spread, "repository", "file_path")
    if columns is None and keep is None:
        return files.mapInArrow(_flatten_batches, SCHEMA)
    wanted = T.StructType([f for f in SCHEMA if columns is None or f.name in columns])
    return files.mapInArrow(lambda batches: _flatten_batches(batches, wanted, keep), wanted)
