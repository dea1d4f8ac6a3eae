"""A keyed table kept by micro-batches, as a log with compaction.

Each micro-batch writes its rows to a folder of its own, so a replayed batch
overwrites only itself and a write costs the batch, not the table. The table
is ``merge`` over all rows. Compaction merges a prefix of the batches into
one base; readers take the newest complete base and the batches after it, so
reading costs the base and one interval, however long the log has run.

A base is complete once its ``_SUCCESS`` file stands, which the writer leaves
last: a crash before that leaves the old base and all batches in use, a crash
behind it loses nothing. What a base covers is deleted one compaction later,
so that a reader that has just listed the old state can still finish.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from stockroom.session import drop_tables, list_folder, path_exists


class BatchLog:
    def __init__(self, spark: SparkSession, path: str, schema: str, merge: Callable[[DataFrame], DataFrame]) -> None:
        """``merge`` maps rows to rows of the same schema, one per key;
        merging merged rows again with later ones must give the same table."""
        self.spark, self.path, self.merge = spark, path.rstrip("/"), merge
        self.schema = T.StructType.fromDDL(schema)

    def _numbers(self, kind: str) -> list[int]:
        """Numbers of the folders ``<kind>-<n>`` that are complete."""
        names = [n for n in list_folder(self.spark, self.path) if n.startswith(kind + "-")]
        return sorted(int(n.removeprefix(kind + "-")) for n in names if path_exists(self.spark, f"{self.path}/{n}/_SUCCESS"))

    def _folder(self, kind: str, n: int) -> str:
        return f"{self.path}/{kind}-{n}"

    def append(self, rows: DataFrame, batch_id: int, extra: str = "") -> DataFrame:
        """Write a batch's rows (replacing an earlier try) and read them back,
        with columns ``extra`` that the table itself does not have."""
        schema = T.StructType([*self.schema.fields, *(T.StructType.fromDDL(extra).fields if extra else [])])
        path = self._folder("batch", batch_id)
        rows.select(*schema.fieldNames()).write.mode("overwrite").parquet(path)
        return self.spark.read.schema(schema).parquet(path)

    def _parts(self, before: int | None) -> tuple[int, list[str]]:
        """(what the base covers, the folders to read) as of before a batch."""
        bases = [n for n in self._numbers("base") if before is None or n < before]
        covered = bases[-1] if bases else -1
        batches = [n for n in self._numbers("batch") if n > covered and (before is None or n < before)]
        return covered, [self._folder("base", covered)] * bool(bases) + [self._folder("batch", n) for n in batches]

    def read(self, before: int | None = None) -> DataFrame:
        """The table, or as it was before a batch."""
        paths = self._parts(before)[1]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.merge(self.spark.read.schema(self.schema).parquet(*paths))

    def compact(self, upto: int, keep: Column | None = None) -> None:
        """One base for all batches up to ``upto``; rows that ``keep`` does not
        hold for are dropped from the table."""
        old = self._numbers("base")
        if upto in old:  # a replayed batch: done, and a base must not be overwritten from itself
            return
        rows = self.read(upto + 1)
        (rows if keep is None else rows.filter(keep)).write.mode("overwrite").parquet(self._folder("base", upto))
        if old:  # what the base before this one covers has no reader any more
            gone = [self._folder("batch", n) for n in self._numbers("batch") if n <= old[-1]]
            drop_tables(self.spark, gone + [self._folder("base", n) for n in old[:-1]])
