"""Path normalisation and the keep/exclude rules for source files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from codetide.functions.text import first_lines


@dataclass(frozen=True)
class DiscoveryRules:
    """Names and words that mark a file as test, setup or generated."""

    # fixed values
    test_dirs: tuple[str, ...] = ("tests", "test")
    test_names: tuple[str, ...] = ("conftest.py",)
    test_prefixes: tuple[str, ...] = ("test_",)
    test_suffixes: tuple[str, ...] = ("_test.py",)
    setup_names: tuple[str, ...] = ("setup.py", "_setup.py")
    generated_names: tuple[str, ...] = ("_version.py", "version.py", "_generated.py")
    generated_suffixes: tuple[str, ...] = ("_pb2.py", "_pb2_grpc.py")
    markers: tuple[str, ...] = (
        "auto-generated",
        "autogenerated",
        "automatically generated",
        "do not edit",
        "do not modify",
        "@generated",
        "generated by",
        "this file is generated",
    )
    header_lines: int = 40


def _any(conditions: list[Column]) -> Column:
    out = F.lit(False)
    for condition in conditions:
        out = out | condition
    return out


def normalise(path: Column) -> Column:
    """Forward slashes, no empty or ``.`` segments; ``..`` stays as written."""
    slashed = F.replace(path, F.lit("\\"), F.lit("/"))
    kept = F.filter(F.split(slashed, "/"), lambda s: (s != "") & (s != "."))
    return F.concat(F.when(slashed.startswith("/"), "/").otherwise(""), F.array_join(kept, "/"))


def _resolved(absolute: Column) -> Column:
    """Segments of an absolute path with every ``..`` applied (the root absorbs extras)."""
    start = F.array().cast("array<string>")

    def step(acc: Column, segment: Column) -> Column:
        return (
            F.when(segment.isin("", "."), acc)
            .when(segment == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
            .otherwise(F.array_append(acc, segment))
        )

    return F.aggregate(F.split(absolute, "/"), start, step)


def stays_inside(path: Column, root: str) -> Column:
    """True when ``root/path`` is still at or below ``root`` once resolved."""
    slashed = F.replace(path, F.lit("\\"), F.lit("/"))
    full = F.when(slashed.startswith("/"), slashed).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), slashed))
    home = [s for s in root.split("/") if s]
    resolved = _resolved(full)
    return F.slice(resolved, 1, max(len(home), 1)) == F.array(*[F.lit(s) for s in home]) if home else F.lit(True)


def is_source_path(path: Column, suffix: str = "py") -> Column:
    """The last segment has a stem and the suffix, in any case."""
    pattern = "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in suffix)
    return path.rlike(rf"[^/]\.{pattern}$")


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def is_test(path: Column, rules: DiscoveryRules = DiscoveryRules()) -> Column:
    name = base_name(path)
    parts = F.split(path, "/")
    return _any(
        [F.arrays_overlap(parts, F.array(*[F.lit(d) for d in rules.test_dirs]))]
        + [name.isin(*rules.test_names)]
        + [name.startswith(p) for p in rules.test_prefixes]
        + [name.endswith(s) for s in rules.test_suffixes]
    )


def is_setup(path: Column, rules: DiscoveryRules = DiscoveryRules()) -> Column:
    return base_name(path).isin(*rules.setup_names)


def is_generated_name(path: Column, rules: DiscoveryRules = DiscoveryRules()) -> Column:
    name = base_name(path)
    return _any([name.isin(*rules.generated_names)] + [name.endswith(s) for s in rules.generated_suffixes])


def has_generated_marker(text: Column, rules: DiscoveryRules = DiscoveryRules()) -> Column:
    header = F.lower(first_lines(text, rules.header_lines))
    return F.coalesce(_any([header.contains(m) for m in rules.markers]), F.lit(False))


def exclude_reasons(path: Column, text: Column, rules: DiscoveryRules = DiscoveryRules()) -> Column:
    """Every reason that applies, in the order test, setup, auto-generated."""
    return F.array_compact(
        F.array(
            F.when(is_test(path, rules), "test"),
            F.when(is_setup(path, rules), "setup"),
            F.when(is_generated_name(path, rules) | has_generated_marker(text, rules), "auto-generated"),
        )
    )
