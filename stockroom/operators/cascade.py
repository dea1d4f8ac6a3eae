"""Deletes over the whole reference graph (C7): cascades and restricts.

``tables`` maps names to frames with a single-column primary key; a
``Reference`` says that a child column names a parent's key and what a delete
of the parent does. Requests name rows to delete. A request takes the rows
that cascade from its row, over any number of levels; it is refused as a
whole if any of them is still named by a restricting reference, whether or
not the naming row would go as well (the reference engine tests a restrict
at once). Requests are judged against the tables as they stand, each by
itself, so their order does not matter; a row goes if some accepted request
takes it.

Both directions are set operations. Down: each level joins the newly reached
keys with the children's reference columns, tagged with the request they come
from, until no new row is reached; a diamond reaches a row once per request.
Up: restricting children are reduced to the distinct keys they name before
they are joined, so a parent with very many children costs one row, and a
refusal travels to its request by the tag. Each level is written.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockroom.session import cut_lineage

CASCADE, RESTRICT = "CASCADE", "RESTRICT"
ROOT = ["root_table", "root_key"]


@dataclass(frozen=True)
class Reference:
    child: str
    column: str
    parent: str
    on_delete: str = RESTRICT


def _reached_children(reached: DataFrame, ref: Reference, tables: Mapping[str, DataFrame], keys: Mapping[str, str]) -> DataFrame:
    """(root, key) of the child rows that name a reached row."""
    child = tables[ref.child].select(F.col(ref.column).alias("_named"), F.col(keys[ref.child]).cast("long").alias("_child"))
    return reached.join(child, F.col("key") == F.col("_named")).select(*ROOT, F.col("_child").alias("key"))


def closure(
    requests: DataFrame, tables: Mapping[str, DataFrame], keys: Mapping[str, str], references: Sequence[Reference]
) -> DataFrame:
    """(root_table, root_key, table, key, level): all rows that each request
    would take. Requests: (table, key); one whose row does not exist takes nothing."""
    reached: list[DataFrame] = []
    front: dict[str, DataFrame] = {}
    for name, frame in tables.items():
        asked = requests.filter(F.col("table") == name).select(F.col("key").cast("long").alias("key")).distinct()
        there = frame.select(F.col(keys[name]).cast("long").alias("key")).join(asked, "key", "left_semi").distinct()
        front[name] = there.select(F.lit(name).alias("root_table"), F.col("key").alias("root_key"), "key")
    known: dict[str, DataFrame] = {}
    level = 0
    while front:
        front = {name: cut_lineage(frame, f"delete-{level}-{name}") for name, frame in front.items()}
        front = {name: frame for name, frame in front.items() if not frame.isEmpty()}
        found: dict[str, list[DataFrame]] = {}
        for name, frame in front.items():
            reached.append(frame.select(*ROOT, F.lit(name).alias("table"), "key", F.lit(level).alias("level")))
            known[name] = known[name].unionByName(frame) if name in known else frame
            for ref in references:
                if ref.parent == name and ref.on_delete == CASCADE:
                    found.setdefault(ref.child, []).append(_reached_children(frame, ref, tables, keys))
        front = {}
        for name, parts in found.items():
            new = reduce(DataFrame.unionByName, parts).distinct()
            front[name] = new.join(known[name], [*ROOT, "key"], "left_anti") if name in known else new
        level += 1
    empty = requests.sparkSession.createDataFrame([], "root_table string, root_key long, table string, key long, level int")
    return reduce(DataFrame.unionByName, reached, empty)


def refusals(taken: DataFrame, tables: Mapping[str, DataFrame], references: Sequence[Reference]) -> DataFrame:
    """(root_table, root_key, blocked_by): the first restricting child table, by
    name, that names a row which the request would take."""
    blocked = [taken.limit(0).select(*ROOT, F.lit("").alias("by"))]
    for ref in references:
        if ref.on_delete != RESTRICT:
            continue
        named = tables[ref.child].select(F.col(ref.column).cast("long").alias("key")).filter("key is not null").distinct()
        hit = taken.filter(F.col("table") == ref.parent).join(named, "key", "left_semi")
        blocked.append(hit.select(*ROOT, F.lit(ref.child).alias("by")))
    return reduce(DataFrame.unionByName, blocked).groupBy(*ROOT).agg(F.min("by").alias("blocked_by"))


class Deletion:
    """What a set of delete requests does to the tables."""

    def __init__(self, requests: DataFrame, tables: Mapping[str, DataFrame], keys: Mapping[str, str], references: Sequence[Reference]) -> None:
        self.requests, self.tables, self.keys = requests, tables, keys
        self.taken = cut_lineage(closure(requests, tables, keys, references), "delete-closure")
        self.refused = cut_lineage(refusals(self.taken, tables, references), "delete-refused")

    def outcomes(self) -> DataFrame:
        """(table, key, outcome, blocked_by, rows): one row per requested row;
        ``rows`` counts what goes with it, itself included."""
        asked = self.requests.select(F.col("table").alias("root_table"), F.col("key").cast("long").alias("root_key")).distinct()
        sizes = self.taken.groupBy(*ROOT).agg(F.count(F.lit(1)).alias("_rows"))
        j = asked.join(sizes, ROOT, "left").join(self.refused, ROOT, "left")
        outcome = F.when(F.col("_rows").isNull(), "MISSING").when(F.col("blocked_by").isNotNull(), "RESTRICTED").otherwise("DELETED")
        return j.select(
            F.col("root_table").alias("table"), F.col("root_key").alias("key"), outcome.alias("outcome"), "blocked_by",
            F.when(outcome == "DELETED", F.col("_rows")).otherwise(F.lit(0)).cast("long").alias("rows"),
        )

    def survivors(self, name: str) -> DataFrame:
        """The rows of a table that are left."""
        gone = self.taken.filter(F.col("table") == name).join(self.refused, ROOT, "left_anti").select("key").distinct()
        return self.tables[name].join(gone, F.col(self.keys[name]).cast("long") == F.col("key"), "left_anti")
