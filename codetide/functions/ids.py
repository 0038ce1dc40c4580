"""Content-derived ids as JVM-side column expressions.

An id is ``prefix:sha256(json)`` where ``json`` is the compact JSON array of the
parts.  JSON framing keeps ``("ab", "c")`` apart from ``("a", "bc")``, and time
never takes part, so equal content gives equal ids on every run.  Control
characters inside a part follow Spark's escape spelling (upper-case hex).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class Number:
    """Marks a part that is written without quotes."""

    column: Column


def _json_array(parts: list[Column | Number]) -> Column:
    if not any(isinstance(part, Number) for part in parts):
        return F.to_json(F.array(*[p.cast("string") for p in parts]))
    *before, last = parts
    if before and isinstance(last, Number) and not any(isinstance(part, Number) for part in before):
        # the common case: bytes are cut and joined, which costs a fraction of trimming characters
        text = F.to_json(F.array(*[p.cast("string") for p in before])).cast("binary")
        opened = F.substring(text, F.lit(1), F.octet_length(text) - 1)
        number = F.coalesce(last.column.cast("string"), F.lit("null"))
        return F.concat(opened, F.concat(F.lit(","), number, F.lit("]")).cast("binary"))
    pieces: list[Column] = []
    run: list[Column] = []

    def close_run() -> None:
        if run:
            # a part starts and ends with a quote (or is null), so only the brackets go
            pieces.append(F.btrim(F.to_json(F.array(*run)), F.lit("[]")))
            run.clear()

    for part in parts:
        if isinstance(part, Number):
            close_run()
            pieces.append(F.coalesce(part.column.cast("string"), F.lit("null")))
        else:
            run.append(part.cast("string"))
    close_run()
    return F.concat(F.lit("["), F.concat_ws(",", *pieces), F.lit("]"))


def stable_hash(prefix: str, *parts: Column | Number | str) -> Column:
    columns = [F.lit(p) if isinstance(p, str) else p for p in parts]
    digest = F.sha2(_json_array(columns).cast("binary"), 256)
    return F.concat(F.lit(prefix + ":"), digest)


def node_id(
    repository: Column,
    file_path: Column,
    scope: Column,
    kind: Column | str,
    signature: Column,
    occurrence: Column,
) -> Column:
    return stable_hash("n", repository, file_path, scope, kind, signature, Number(occurrence))


def external_symbol_id(repository: Column, file_path: Column, symbol: Column) -> Column:
    """Owned by its file, so cleaning one file never removes another file's symbol."""
    return stable_hash("n", repository, file_path, "external-symbol", symbol)


def node_parts(scope: Column, kind: Column, signature: Column, occurrence: Column) -> Column:
    """What a node's id is made of besides its file: a struct that ``made`` turns into the id."""
    return F.struct(scope.alias("scope"), kind.alias("kind"), signature.alias("signature"), occurrence.cast("int").alias("occurrence"))


def external_parts(symbol: Column) -> Column:
    """The same of an external symbol, which has neither scope nor occurrence."""
    none = F.lit(None)
    return node_parts(none.cast("string"), F.lit("external-symbol"), symbol, none)


def made(repository: Column, file_path: Column, parts: Column) -> Column:
    """The id of ``node_parts`` or ``external_parts``; null where there are none."""
    external = external_symbol_id(repository, file_path, parts["signature"])
    node = node_id(repository, file_path, parts["scope"], parts["kind"], parts["signature"], parts["occurrence"])
    return F.when(parts.isNotNull(), F.when(parts["occurrence"].isNull(), external).otherwise(node))


def edge_id(edge_type: Column | str, src: Column, dst: Column, anchor: Column | str) -> Column:
    return stable_hash("e", edge_type, src, dst, anchor)


def packed(an_id: Column) -> Column:
    """An id in half its bytes, for shuffles; any other text as it is.  ``unpacked`` gives both back."""
    is_id = an_id.rlike(r"^[a-z]:[0-9a-f]{64}\z")
    short = F.concat(F.substring(an_id, 1, 1).cast("binary"), F.unhex(F.substring(an_id, 3, 64)))
    return F.when(is_id, short).when(an_id.isNotNull(), F.concat(F.unhex(F.lit("00")), an_id.cast("binary")))


def unpacked(short: Column) -> Column:
    head, tail = F.substring(short, 1, 1), F.substring(short, 2, 2147483647)
    text = F.concat(head.cast("string"), F.lit(":"), F.lower(F.hex(tail)))
    return F.when(head == F.unhex(F.lit("00")), tail.cast("string")).otherwise(text)


def file_id(repository: Column, file_path: Column) -> Column:
    return stable_hash("f", repository, file_path)


def content_sha256(content: Column) -> Column:
    return F.sha2(content.cast("binary"), 256)


def error_id(
    repository: Column,
    file_path: Column,
    content_hash: Column,
    stage: Column,
    error_type: Column,
    message: Column,
) -> Column:
    return stable_hash("err", repository, file_path, content_hash, stage, error_type, message)


def stack_hash(error_type: Column, message: Column, stage: Column) -> Column:
    return stable_hash("stack", error_type, message, stage)
