"""Names, scopes and signatures of syntax nodes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from codetide.contract import MODULE_SCOPE
from codetide.functions.text import preview
from codetide.operators.flatten import SIGNATURE_WIDTH

DEFINITIONS = ("FunctionDef", "AsyncFunctionDef", "ClassDef")


def qualified(scope: Column, name: Column) -> Column:
    return F.when(scope == MODULE_SCOPE, name).otherwise(F.concat_ws(".", scope, name))


def parent_scope(scope: Column) -> Column:
    """Without its last dotted component; null when there is only one."""
    return F.when(scope.contains("."), F.regexp_replace(scope, r"\.[^.]*$", ""))


def last_component(symbol: Column) -> Column:
    return F.substring_index(symbol, ".", -1)


def bound_name(name: Column, alias: Column) -> Column:
    """What an import binds: its alias, else the first dotted component."""
    return F.coalesce(alias, F.substring_index(name, ".", 1))


def display_name(kind: Column, ident: Column, alias: Column, callee: Column) -> Column:
    return (
        F.when(kind.isin(*DEFINITIONS, "Name", "arg", "Attribute"), ident)
        .when(kind == "alias", F.coalesce(alias, ident))
        .when(kind == "Call", callee)
        .when(kind == "Module", F.lit("module"))
    )


def signature(
    kind: Column,
    ident: Column,
    alias: Column,
    ctx: Column,
    value_type: Column,
    value_preview: Column,
    shape_hash: Column,
) -> Column:
    """What tells one node from its like within a scope; positions never enter."""
    return (
        F.when(kind == "Module", F.lit("module"))
        .when(kind.isin(*DEFINITIONS, "arg"), ident)
        .when(kind == "Name", F.concat_ws(":", ident, ctx))
        .when(kind == "Attribute", F.concat(F.lit("attribute:"), ident))
        .when(kind == "alias", F.concat(ident, F.lit(":"), F.coalesce(alias, F.lit(""))))
        .when(
            kind == "Constant",
            F.concat(F.lit("constant:"), value_type, F.lit(":"), preview(value_preview, SIGNATURE_WIDTH)),
        )
        .otherwise(shape_hash)
    )


def call_candidates(symbol: Column, scope: Column) -> Column:
    """Symbols a call may mean, best first; the bare last component closes the list.

    A bare name is tried from the innermost scope outwards, ``self.``/``cls.`` in
    the scope around the caller, any other dotted name as it stands.
    """
    levels = F.split(scope, r"\.")
    enclosing = F.transform(
        F.sequence(F.size(levels), F.lit(1), F.lit(-1)),
        lambda depth: F.concat_ws(".", F.slice(levels, 1, depth), symbol),
    )
    on_instance = symbol.startswith("self.") | symbol.startswith("cls.")
    method = F.concat_ws(".", parent_scope(scope), F.regexp_replace(symbol, r"^(self|cls)\.", ""))
    none = F.array().cast("array<string>")
    ranked = (
        F.when(on_instance & scope.contains("."), F.array(method))
        .when(on_instance, none)
        .when(symbol.contains("."), F.array(symbol))
        .when(scope == MODULE_SCOPE, F.array(symbol))
        .otherwise(F.concat(enclosing, F.array(symbol)))
    )
    return F.concat(ranked, F.array(last_component(symbol)))
