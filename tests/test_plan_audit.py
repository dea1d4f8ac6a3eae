"""Plan audit of every registered batch query.

Planned as on large data (no size-based broadcast, no runtime re-plan):
a single-partition exchange may only feed a global (keyless) aggregate,
i.e. a one-row result after map-side partial aggregation; no cartesian or
nested-loop joins; no row-at-a-time Python UDFs.
"""

from conftest import SF0001
from stockroom.plans import registry

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")


def test_every_batch_plan_is_distributed(spark):
    saved = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    problems = []
    try:
        for name, fn in sorted(registry.all_queries().items()):
            if name.startswith("stream_"):
                continue
            lines = fn(spark, SF0001)._jdf.queryExecution().executedPlan().toString().splitlines()
            for i, line in enumerate(lines):
                if "Exchange SinglePartition" in line and "HashAggregate(keys=[]" not in lines[i - 1]:
                    problems.append(f"{name}: single-partition exchange under {lines[i - 1].strip()[:80]}")
                problems += [f"{name}: {bad}" for bad in FORBIDDEN if bad in line]
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    assert not problems, "\n".join(problems)
