"""Deletes over reference graphs and the compiled constraint catalogue."""

import random

import pytest

from conftest import SF0001
from stockroom.operators import catalogue
from stockroom.operators.cascade import CASCADE, Deletion, Reference
from stockroom.plans import wiring
from stockroom.sources.fixtures import Fixtures


def _frames(spark, tables):
    return {t: spark.createDataFrame(rows, ", ".join(f"{c} long" for c in ["id", *columns])) for t, (columns, rows) in tables.items()}


def serial(tables, references, requests):
    """Each request by itself, row by row, against the tables as they stand."""
    rows = {t: {r[0]: dict(zip(["id", *columns], r)) for r in its} for t, (columns, its) in tables.items()}
    outcomes, gone = {}, set()
    for table, key in requests:
        if key not in rows[table]:
            outcomes[table, key] = ("MISSING", None, 0)
            continue
        taken, todo = set(), [(table, key)]
        while todo:
            t, k = todo.pop()
            if (t, k) in taken:
                continue
            taken.add((t, k))
            todo += [(r.child, c["id"]) for r in references if r.parent == t and r.on_delete == CASCADE for c in rows[r.child].values() if c[r.column] == k]
        blockers = {r.child for r in references if r.on_delete != CASCADE for t, k in taken if r.parent == t and any(c[r.column] == k for c in rows[r.child].values())}
        outcomes[table, key] = ("RESTRICTED", min(blockers), 0) if blockers else ("DELETED", None, len(taken))
        gone |= set() if blockers else taken
    return outcomes, {t: sorted(k for k in its if (t, k) not in gone) for t, its in rows.items()}


def check(spark, tables, references, requests):
    frames = _frames(spark, tables)
    d = Deletion(spark.createDataFrame(requests, "table string, key long"), frames, dict.fromkeys(tables, "id"), references)
    got = {(r["table"], r["key"]): (r["outcome"], r["blocked_by"], r["rows"]) for r in d.outcomes().collect()}
    left = {t: sorted(r["id"] for r in d.survivors(t).collect()) for t in tables}
    assert (got, left) == serial(tables, references, requests)
    return got, left


def test_chain_and_diamond(spark):
    tables = {
        "a": ([], [(1,), (2,), (3,), (4,)]),
        "b": (["a"], [(10, 1), (11, 2), (12, 3), (13, None)]),
        "c": (["a"], [(20, 1), (21, 3)]),
        "d": (["b", "c"], [(30, 10, 20), (31, 12, 21), (32, 11, None)]),
        "e": (["d"], [(40, 31), (41, None)]),
    }
    references = [Reference("b", "a", "a", CASCADE), Reference("c", "a", "a", CASCADE), Reference("d", "b", "b", CASCADE),
                  Reference("d", "c", "c", CASCADE), Reference("e", "d", "d")]
    got, left = check(spark, tables, references, [("a", 1), ("a", 3), ("c", 21), ("b", 11), ("a", 9), ("d", 32)])
    assert got["a", 1] == ("DELETED", None, 4)  # 30 is reached twice and counted once
    assert got["a", 3] == ("RESTRICTED", "e", 0) and got["c", 21] == ("RESTRICTED", "e", 0)
    assert left["d"] == [31] and left["b"] == [12, 13]


def test_cycles_and_random_graphs(spark):
    draw = random.Random(11)
    names = ["a", "b", "c"]
    for _ in range(2):
        tables = {t: (["x", "y"], [(i, draw.choice([None, *range(8)]), draw.choice([None, *range(8)])) for i in range(8)]) for t in names}
        references = [Reference("a", "x", "a", CASCADE), Reference("b", "x", "a", CASCADE), Reference("c", "y", "b", CASCADE),
                      Reference("c", "x", "c", CASCADE), Reference("b", "y", "c")]
        check(spark, tables, references, [(draw.choice(names), draw.randrange(10)) for _ in range(9)])


@pytest.fixture(scope="module")
def report(spark):
    return catalogue.violations(wiring.DECLARED, Fixtures(spark, SF0001).broken_tables)


def test_one_scan_for_the_rows_of_a_table(spark):
    frames = Fixtures(spark, SF0001).broken_tables
    for t in wiring.DECLARED:
        plan = catalogue.row_violations(t, frames[t.name])._jdf.queryExecution().optimizedPlan().toString()
        base = frames[t.name]._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [") == base.count("Relation [")
    keys = catalogue.key_violations(wiring.DECLARED, frames)._jdf.queryExecution().optimizedPlan().toString()
    assert keys.count("Relation [") == sum(f._jdf.queryExecution().optimizedPlan().toString().count("Relation [") for f in frames.values())
    # all keys and references meet in one aggregate
    assert keys.count("Aggregate [domain") == 1


def test_every_kind_is_found(spark, report):
    kinds = {(r["kind"]) for r in report.select("kind").distinct().collect()}
    assert kinds == {"NOT NULL", "CHECK", "ENUM", "PRIMARY KEY", "UNIQUE", "FOREIGN KEY"}


def test_nulls_and_composite_keys(spark):
    parent = spark.createDataFrame([(1, "x"), (2, None), (2, "y"), (None, "z")], "id long, name string")
    child = spark.createDataFrame([(1, 1, "a", None), (2, 9, "a", 3), (3, None, "a", 3), (4, 9, None, 3), (5, None, None, 3)], "id long, parent long, p string, q int")
    tables = [catalogue.Table("parent", "id", unique={"name": ["name"]}),
              catalogue.Table("child", "id", ["p"], {"pq": ["p", "q"]}, {"small": "q < 3"}, {"p": ["B"]}, {"parent": "parent"})]
    got = {tuple(r) for r in catalogue.violations(tables, {"parent": parent, "child": child}).collect()}
    assert got == {
        ("parent", "NOT NULL", "id", None, 1), ("parent", "PRIMARY KEY", "id", "2", 2),
        ("child", "NOT NULL", "p", "4", 1), ("child", "NOT NULL", "p", "5", 1),
        *(("child", "CHECK", "small", str(k), 1) for k in (2, 3, 4, 5)), *(("child", "ENUM", "p", str(k), 1) for k in (1, 2, 3)),
        ("child", "UNIQUE", "pq", '["a","3"]', 2), ("child", "FOREIGN KEY", "parent", "9", 2),
    }
