from __future__ import annotations

import random
import statistics
from collections import defaultdict

import pytest

from tidewire.operators import quantiles
from tidewire.operators.quantiles import exact_median


@pytest.mark.parametrize(("ranges", "few"), [(1024, 1000), (4, 3)])
def test_medians_equal_sorting(spark, monkeypatch, ranges, few):
    monkeypatch.setattr(quantiles, "RANGES", ranges)
    monkeypatch.setattr(quantiles, "SORTED", few)
    draw = random.Random(ranges)
    rows = [(draw.choice(["hot", "hot", "hot", "a", None, "b"]), draw.choice([None, float("nan"), 1.0, 1.0, 2.5, -7.25, 1e300, -1e300, draw.gauss(0, 1), draw.random() * 1e-9])) for _ in range(400)]
    rows += [("one", 3.0), ("two", 1.0), ("two", 4.0), ("none", None), ("same", 5.0)] + [("same", 5.0)] * 50 + [("ends", -1.7e308), ("ends", 1.7e308), ("far", 1.7e308), ("far", 1.7e308)]
    want = defaultdict(list)
    for k, v in rows:
        want[k] += [v] if v is not None and v == v else []
    got = {r.k: (r.n, r.median) for r in exact_median(spark.createDataFrame(rows, "k string, v double"), ["k"], "v").collect()}
    assert got.keys() == want.keys()
    for k, values in want.items():
        n, median = got[k]
        expected = None if not values else 1.7e308 if k == "far" else statistics.median(values)
        assert n == len(values) and (median == expected if expected is None else median == pytest.approx(expected, rel=1e-15, abs=0))


def test_medians_of_an_empty_table_and_of_several_keys(spark):
    assert exact_median(spark.createDataFrame([], "k string, j int, v int"), ["k", "j"], "v").collect() == []
    rows = spark.createDataFrame([("a", 1, 2), ("a", 1, 4), ("a", 2, 9)], "k string, j int, v int")
    assert sorted(map(tuple, exact_median(rows, ["k", "j"], "v", "m").collect())) == [("a", 1, 2, 3.0), ("a", 2, 1, 9.0)]
