"""Declared paths into JSON records ($, .name, [*], [n], alternatives by |), compiled to column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_STEP = re.compile(r"\.([A-Za-z_][\w-]*)|\[(\*|\d+)\]")


def parse(path: str) -> list[list[str | int]]:
    """Steps of each alternative: names, numbers, or '*'. ValueError for what is no path."""
    out = []
    for one in path.split("|"):
        one = one.strip()
        if not one.startswith("$"):
            raise ValueError(f"a path starts with $: {path!r}")
        steps: list[str | int] = []
        at = 1
        while at < len(one):
            m = _STEP.match(one, at)
            if not m:
                raise ValueError(f"no path: {one!r} at {at}")
            steps.append(m[1] if m[1] else "*" if m[2] == "*" else int(m[2]))
            at = m.end()
        out.append(steps)
    return out


def _text(steps: list[str | int]) -> str:
    return "$" + "".join(f"[{s}]" if isinstance(s, int) or s == "*" else f".{s}" for s in steps)


def _present(record: Column, steps: list[str | int]) -> Column:
    """Whether a record has something at these steps, JSON null included."""
    if not steps:
        return record.isNotNull()
    if "*" in steps:
        return F.get_json_object(record, _text(steps)).isNotNull()
    holder = record if len(steps) == 1 else F.get_json_object(record, _text(steps[:-1]))
    if isinstance(steps[-1], int):
        return F.coalesce(F.json_array_length(holder) > steps[-1], F.lit(False))
    return F.coalesce(F.array_contains(F.json_object_keys(holder), steps[-1]), F.lit(False))


def _found(record: Column, steps: list[str | int]) -> Column:
    """What is at these steps, as text; a list's member that is JSON null is null, not the text "null"."""
    if steps and isinstance(steps[-1], int) and "*" not in steps:
        holder = record if len(steps) == 1 else F.get_json_object(record, _text(steps[:-1]))
        return F.get(F.from_json(holder, "array<string>"), F.lit(steps[-1]))
    return F.get_json_object(record, _text(steps))


def value(record: Column, path: str) -> Column:
    """The first alternative that is there, as text; one that is there as JSON null gives null. Null if none is."""
    parts = [(_present(record, steps), _found(record, steps)) for steps in parse(path)]
    if len(parts) == 1:
        return parts[0][1]
    out = F.when(*parts[0])
    for there, found in parts[1:]:
        out = out.when(there, found)
    return out


def values(record: Column, path: str) -> Column:
    """All values of the first alternative that has any, as array<string>; a single value is an array of one."""
    found = value(record, path)
    listed = F.from_json(found, "array<string>")
    return F.when(found.isNull(), F.expr("array()").cast("array<string>")).when(F.left(F.ltrim(found), F.lit(1)) == "[", F.coalesce(listed, F.array(found))).otherwise(F.array(found))


def leaves(path: str) -> set[str]:
    """Names that a path ends in."""
    return {str(steps[-1]) for steps in parse(path) if steps and isinstance(steps[-1], str) and steps[-1] != "*"}


def validate(spec: dict) -> list[str]:
    """What is wrong with a dataset's declaration; empty if nothing is."""
    wrong = [f"missing {k}" for k in ("path", "kind", "body") if not spec.get(k)]
    if spec.get("root", "list") not in ("list", "dict", "dict_or_list"):
        wrong.append(f"root {spec['root']!r}")
    for k in ("body", "title", "author", "id", "tags"):
        try:
            parse(spec.get(k) or "$")
        except ValueError as e:
            wrong.append(f"{k}: {e}")
    return wrong
