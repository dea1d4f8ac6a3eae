"""Data-quality checks and table maintenance from declared constraints.

Constraints the reference enforces at write time become set-based checks
over whole tables: grouped counts (partial aggregation absorbs hot keys),
anti/semi joins and filters.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unique_violations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Key values that occur more than once; NULL keys never collide."""
    cols = list(cols)
    not_null = F.lit(True)
    for c in cols:
        not_null = not_null & F.col(c).isNotNull()
    return (
        df.filter(not_null)
        .groupBy(*cols)
        .agg(F.count(F.lit(1)).alias("dup_count"))
        .filter(F.col("dup_count") > 1)
    )


def foreign_key_violations(
    child: DataFrame, parent: DataFrame, keys: Mapping[str, str], keep: Sequence[str] | None = None
) -> DataFrame:
    """Child rows whose (non-NULL) reference has no parent row."""
    renamed = parent.select(*[F.col(p).alias(c) for c, p in keys.items()]).distinct()
    cond = F.lit(True)
    for c in keys:
        cond = cond & F.col(c).isNotNull()
    out = child.filter(cond).join(renamed, list(keys), "left_anti")
    return out.select(*keep) if keep else out


def check_violations(df: DataFrame, rules: Mapping[str, Column], keep: Sequence[str]) -> DataFrame:
    """One row per (row, rule) where the rule is FALSE (NULL passes).

    All rules are evaluated in one pass over the table.
    """
    failing = F.array(*[F.when(~expr, F.lit(name)) for name, expr in rules.items()])
    return (
        df.select(*keep, F.filter(failing, lambda x: x.isNotNull()).alias("_failed"))
        .filter(F.size("_failed") > 0)
        .select(*keep, F.explode("_failed").alias("rule_name"))
    )


def enum_violations(
    df: DataFrame, col: str, allowed: Sequence[str], keep: Sequence[str], case_insensitive: bool = False
) -> DataFrame:
    """C4: non-NULL values outside the allowed list."""
    value = F.col(col)
    if case_insensitive:
        ok = F.lower(value).isin([a.lower() for a in allowed])
    else:
        ok = value.isin(list(allowed))
    return df.filter(value.isNotNull() & ~ok).select(*keep, value.alias("invalid_value"))


def apply_defaults(df: DataFrame, defaults: Mapping[str, Column]) -> DataFrame:
    """Add omitted columns with their defaults; explicit NULLs stay."""
    missing = {c: v for c, v in defaults.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], mode: str = "update"
) -> DataFrame:
    """Insert-or-ignore (``mode='ignore'``) or insert-or-update by key.

    ``ignore``: target plus source rows with new keys (anti join + union).
    ``update``: full outer join; a matched key takes the source row.
    Source keys are expected unique (as a primary key guarantees).
    """
    keys = list(keys)
    if mode == "ignore":
        return target.unionByName(source.join(target.select(*keys), keys, "left_anti"))
    if mode != "update":
        raise ValueError(f"unknown upsert mode {mode}")
    others = [c for c in target.columns if c not in keys]
    t = target.select(*keys, *[F.col(c).alias("_t_" + c) for c in others], F.lit(True).alias("_t"))
    s = source.select(*keys, *[F.col(c).alias("_s_" + c) for c in others], F.lit(True).alias("_s"))
    j = t.join(s, keys, "full_outer")
    return j.select(
        *keys,
        *[F.when(F.col("_s"), F.col("_s_" + c)).otherwise(F.col("_t_" + c)).alias(c) for c in others],
    )


def delete_cascade_restrict(
    requests: DataFrame,
    key: str,
    restrict: Mapping[str, tuple[DataFrame, str]],
    cascade: Mapping[str, tuple[DataFrame, str]],
) -> DataFrame:
    """Outcome of deleting parent keys.

    A key is RESTRICTED when any restrict-child row references it; otherwise
    it is DELETED and its cascade-children rows go with it. Children are
    reduced to per-key counts before joining (no fan-out).
    """
    out = requests.select(key).distinct()
    blocked_cols = []
    for name, (child, fk) in restrict.items():
        counts = child.groupBy(F.col(fk).alias(key)).agg(F.count(F.lit(1)).alias("_r_" + name))
        out = out.join(counts, key, "left")
        blocked_cols.append(name)
    cascade_cols = []
    for name, (child, fk) in cascade.items():
        counts = child.groupBy(F.col(fk).alias(key)).agg(F.count(F.lit(1)).alias("_c_" + name))
        out = out.join(counts, key, "left")
        cascade_cols.append("_c_" + name)
    blocker = F.lit(None).cast("string")
    for name in reversed(blocked_cols):
        blocker = F.when(F.coalesce(F.col("_r_" + name), F.lit(0)) > 0, F.lit(name)).otherwise(blocker)
    cascaded = F.lit(0).cast("long")
    for c in cascade_cols:
        cascaded = cascaded + F.coalesce(F.col(c), F.lit(0))
    return out.select(
        key,
        F.when(blocker.isNull(), "DELETED").otherwise("RESTRICTED").alias("outcome"),
        blocker.alias("blocked_by"),
        F.when(blocker.isNull(), cascaded).otherwise(F.lit(0).cast("long")).alias("cascaded_rows"),
    )
