"""Facts about file contents and errors."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# fixed values: error class -> stage, first match wins
STAGES = (("SyntaxError", "ast_parse"), ("UnicodeError", "decode"), ("OSError", "read_source"))
DEFAULT_STAGE = "parser_service"


def line_count(text: Column) -> Column:
    """Newlines, plus one for a last line without one; an empty text has none."""
    body = text.cast("string")
    newlines = F.octet_length(body) - F.octet_length(F.replace(body, F.lit("\n"), F.lit("")))
    tail = F.when((body == "") | body.endswith("\n"), 0).otherwise(1)
    return (newlines + tail).cast("int")


def byte_count(content: Column) -> Column:
    return F.octet_length(content).cast("bigint")


def first_lines(text: Column, lines: int) -> Column:
    """The first ``lines`` lines; ``\\r\\n`` and a lone ``\\r`` also end a line."""
    unified = F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    return F.substring_index(unified, "\n", lines)


def readable(content: Column) -> Column:
    """Bytes as text, leaving out what is not valid UTF-8."""
    return F.replace(F.make_valid_utf8(content.cast("string")), F.lit("�"), F.lit(""))


def error_stage(classes: Column) -> Column:
    """Stage of an error from its class and base-class names."""
    chain = F.lit(DEFAULT_STAGE)
    for name, stage in reversed(STAGES):
        chain = F.when(F.array_contains(classes, name), stage).otherwise(chain)
    return chain


def preview(text: Column, width: int) -> Column:
    return F.substring(text, 1, width)
