"""Order checks in levels and digests of tables as multisets."""

import random

from arborflow.operators import manifest
from pyspark.sql import functions as F


def test_order_in_levels(spark):
    pick = random.Random(1)
    values = list(range(5_000))
    for _ in range(300):
        a, b = pick.sample(range(5_000), 2)
        values[a], values[b] = values[b], values[a]
    rows = [(p, v, p % 3) for p, v in enumerate(values)]
    table = spark.createDataFrame(rows, "p long, v int, k int").repartition(7)
    want = sum(b <= a for a, b in zip(values, values[1:]))
    for run_length, fan in ((100_000, 10_000), (16, 4), (7, 3)):
        found = manifest.out_of_order(table, F.col("v"), F.col("p"), (), run_length, fan).first().out_of_order
        assert found == want > 100
    per_key = {r.k: r.out_of_order for r in manifest.out_of_order(table, F.col("v"), F.col("p"), ("k",), 16, 4).collect()}
    assert per_key == {k: sum(b <= a for a, b in zip(values[k::3], values[k + 3 :: 3])) for k in range(3)}


def test_digest_of_a_multiset(spark):
    schema = "a string, b double, c map<string,int>, d array<string>"
    rows = [("x", 1.0, {"k": 1, "l": 2}, ["u", None]), ("x", 1.0, {"k": 1, "l": 2}, ["u", None]), (None, 0.0, None, []), ("", None, {}, None)]
    digest = lambda r, s=schema: tuple(manifest.multiset_digest(spark.createDataFrame(r, s).repartition(3)).first())
    whole = digest(rows)
    assert whole == digest(rows[::-1]) == digest([(a, b, c and dict(reversed(c.items())), d) for a, b, c, d in rows])
    assert digest([(a, -b if b == 0 else b, c, d) for a, b, c, d in rows]) == whole
    others = [rows[:3], [*rows, rows[0]], [rows[0], *rows[2:]], [rows[0], rows[0], (None, 0.0, None, [None]), rows[3]], [*rows[:3], (None, None, {}, None)], [*rows[:2], ("", 0.0, None, []), (None, None, {}, None)]]
    assert len({whole, *map(digest, others)}) == 1 + len(others)
    assert digest([("a", None)], "x string, y string") != digest([(None, "a")], "x string, y string")
    assert digest([], schema)[0] == 0


def test_difference_only_of_unequal_runs(spark):
    one, other = spark.createDataFrame([(1,), (2,), (2,)], "n int"), spark.createDataFrame([(2,), (1,), (2,)], "n int")
    assert manifest.run_difference(one, other).count() == 0
    found = manifest.run_difference(one, other.where("n = 2")).collect()
    assert [(r.n, r.only_in, r.copies) for r in found] == [(1, "left", 1)]
