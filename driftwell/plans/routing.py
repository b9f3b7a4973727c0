"""Topics to tables, databases to databases, include and exclude patterns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.values import valid_database


def parse_map(text: str | None, check_values: bool = False) -> dict[str, str]:
    """'a:b, c:d' as a dict; raises ValueError for a part that isn't two names, a name given twice, or a bad database."""
    out: dict[str, str] = {}
    for part in filter(None, map(str.strip, (text or "").split(","))):
        names = [x.strip() for x in part.split(":")]
        if len(names) != 2 or not all(names):
            raise ValueError(f"not a pair of names: {part}")
        if names[0] in out:
            raise ValueError(f"{names[0]} is mapped twice")
        if check_values and not all(map(valid_database, names)):
            raise ValueError(f"not a database name: {part}")
        out[names[0]] = names[1]
    return out


def mapped(value: Column, names: dict[str, str], default: Column) -> Column:
    """Lookup in a small map, as a chain of cases that Spark folds."""
    out = default
    for a, b in names.items():
        out = F.when(value == a, b).otherwise(out)
    return out


def table_of_topic(topic: Column, names: dict[str, str] | None = None) -> Column:
    """The mapped table, else the last part of a topic of three parts or more; null for others."""
    parts = F.split(topic, r"\.")
    return mapped(topic, names or {}, F.when(F.size(parts) >= 3, F.element_at(parts, -1)))


def database_of(db: Column, override: dict[str, str] | None = None) -> Column:
    return mapped(db, override or {}, db)


def included(value: Column, include: list[str] | None = None, exclude: list[str] | None = None) -> Column:
    """Whole-name match of any include pattern (none given: all), and of no exclude pattern."""
    whole = lambda patterns: "^(" + "|".join(f"(?:{p})" for p in patterns) + ")$"
    out = value.rlike(whole(include)) if include else F.lit(True)
    return out & ~value.rlike(whole(exclude)) if exclude else out


def chosen_tables(names: list[str], include: str | None = None, exclude: str | None = None) -> list[str]:
    """Names of a catalog that match the include pattern and not the exclude one."""
    return [n for n in names if (include is None or re.search(include, n)) and (exclude is None or not re.search(exclude, n))]
