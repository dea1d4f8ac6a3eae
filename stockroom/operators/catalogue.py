"""Declared constraints, compiled to two passes.

A ``Table`` declares its primary key, unique keys, columns that must be set,
checks, value lists and references. ``violations`` reports every declared
constraint that some row breaks, in one long form.

* All checks, lists and not-null columns of a table are tested in one scan of
  it: an array of the names that fail, exploded.
* Keys and references of one domain (a parent's key, or a unique key) share
  one shuffle over all tables: every key value goes in as (domain, value, tag),
  the tag saying which declaration it belongs to. One partial aggregate counts
  the tags of a value; a value with a reference but without a key is an orphan,
  one with several rows under a unique tag is a repeated key. A value that a
  third of all rows name is counted before the shuffle.

MySQL's rules hold: a NULL never breaks a check, a list, a unique key or a
reference; a primary key is unique and set. Values of keys compare as text.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REPORT = ["table_name", "kind", "constraint_name", "value", "rows"]


@dataclass(frozen=True)
class Table:
    """Declarations of one table. ``checks``: name -> condition in SQL;
    ``lists``: column -> allowed values; ``references``: column -> parent table
    (its primary key); ``unique``: name -> columns."""

    name: str
    key: str
    required: Sequence[str] = ()
    unique: Mapping[str, Sequence[str]] = field(default_factory=dict)
    checks: Mapping[str, str] = field(default_factory=dict)
    lists: Mapping[str, Sequence[str]] = field(default_factory=dict)
    references: Mapping[str, str] = field(default_factory=dict)


def _named(column: Column) -> Column:
    return column.cast("string")


def row_violations(table: Table, rows: DataFrame) -> DataFrame:
    """Rows that break a check, a list or a not-null declaration."""
    tests: list[tuple[str, str, Column]] = [("NOT NULL", c, F.col(c).isNull()) for c in (table.key, *table.required)]
    tests += [("CHECK", name, ~F.expr(rule)) for name, rule in table.checks.items()]
    # the reference's lists compare without regard to case
    tests += [("ENUM", c, ~F.lower(F.col(c)).isin([v.lower() for v in allowed])) for c, allowed in table.lists.items()]
    failed = F.array_compact(F.array(*(
        F.when(broken, F.struct(F.lit(kind).alias("kind"), F.lit(name).alias("constraint_name"))) for kind, name, broken in tests)))
    found = rows.select(_named(F.col(table.key)).alias("value"), F.explode(failed).alias("f"))
    return found.select(F.lit(table.name).alias("table_name"), "f.kind", "f.constraint_name", "value", F.lit(1).cast("long").alias("rows"))


def _keyed(tables: Sequence[Table]) -> list[tuple[str, str, str, list[str], str]]:
    """(domain, kind, table, columns, name) of every key and reference; the
    parent's key is the first of its domain."""
    out = []
    for t in tables:
        out.append((f"{t.name}.{t.key}", "PRIMARY KEY", t.name, [t.key], t.key))
        out += [(f"{t.name}.{name}", "UNIQUE", t.name, list(columns), name) for name, columns in t.unique.items()]
    parents = {t.name: t.key for t in tables}
    for t in tables:
        out += [(f"{parent}.{parents[parent]}", "FOREIGN KEY", t.name, [column], column) for column, parent in t.references.items()]
    return out


def key_violations(tables: Sequence[Table], frames: Mapping[str, DataFrame]) -> DataFrame:
    """Repeated keys and references without a parent, over all tables."""
    declared = _keyed(tables)
    places: dict[str, int] = {}
    tags = []
    for domain, *_ in declared:
        tags.append(places.get(domain, 0))
        places[domain] = tags[-1] + 1
    parts = []
    for t in tables:  # one scan of a table yields all its key values
        own = [(d, k) for d, k in zip(declared, tags, strict=True) if d[2] == t.name]
        values = []
        for (domain, _, _, columns, _), tag in own:
            whole = reduce(Column.__and__, (F.col(c).isNotNull() for c in columns))
            value = _named(F.col(columns[0])) if len(columns) == 1 else F.to_json(F.array(*(_named(F.col(c)) for c in columns)))
            values.append(F.when(whole, F.struct(F.lit(domain).alias("domain"), value.alias("value"), F.lit(tag).alias("tag"))))
        parts.append(frames[t.name].select(F.inline(F.array_compact(F.array(*values)))))
    width = max(places.values())
    counts = reduce(DataFrame.unionByName, parts).groupBy("domain", "value").agg(
        *(F.count(F.when(F.col("tag") == k, 1)).alias(f"n{k}") for k in range(width)))
    broken = []
    for (domain, kind, name, _, constraint), tag in zip(declared, tags, strict=True):
        n = F.col(f"n{tag}")
        wrong = (n > 0) & (F.col("n0") == 0) if kind == "FOREIGN KEY" else n > 1
        broken.append(F.when((F.col("domain") == domain) & wrong, F.struct(
            F.lit(name).alias("table_name"), F.lit(kind).alias("kind"), F.lit(constraint).alias("constraint_name"), n.alias("rows"))))
    found = counts.select("value", F.explode(F.array_compact(F.array(*broken))).alias("f"))
    return found.select("f.table_name", "f.kind", "f.constraint_name", "value", "f.rows")


def violations(tables: Sequence[Table], frames: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, kind, constraint_name, value, rows): rows that break a
    declared constraint, by the row's key (checks, lists, not null; one row
    each) or by the key value (keys, references; ``rows`` rows)."""
    parts = [row_violations(t, frames[t.name]) for t in tables]
    return reduce(DataFrame.unionByName, [*parts, key_violations(tables, frames)]).select(*REPORT)
