"""Quantiles by counting against sorting."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from countypanel.operators import quantiles


def groups(seed):
    r = random.Random(seed)
    out = {"hot": [r.choice([1.5, 2.5, r.gauss(0, 1)]) for _ in range(900)], "wide": [r.choice([-1, 1]) * 10.0 ** r.randrange(-300, 300) for _ in range(80)],
           "one": [7.0], "same": [3.0] * 40, "two": [1.0, 4.0], None: [r.random() for _ in range(60)], "extreme": [-1.7e308, 1.7e308, 0.0]}
    return out


@pytest.mark.parametrize("few", [0, 16, 4096])
def test_quantiles_equal_sorting(rows, monkeypatch, few):
    monkeypatch.setattr(quantiles, "FEW_ROWS", few)
    data = groups(few)
    table = [(k, v) for k, values in data.items() for v in values] + [("hot", None), ("hot", float("nan")), ("one", float("inf")), ("none", None)]
    df = rows(table, "g string, v double").withColumn("p", F.lit("clash")).repartition(4)
    got = {(r.g, r.p): (r.n, r.value) for r in quantiles.exact_quantiles(df, "v", [0, 0.1, 1 / 3, 0.5, 0.99, 1], ("g",)).collect()}
    assert len(got) == 6 * 8
    for g, values in data.items():
        for p in (0, 0.1, 1 / 3, 0.5, 0.99, 1):
            n, value = got[g, p]
            ordered, at = sorted(values), p * (len(values) - 1)
            low = ordered[int(at)]
            high = ordered[min(int(at) + 1, len(values) - 1)]
            assert n == len(values)
            assert value == pytest.approx(low + (at - int(at)) * (high - low) if at > int(at) else low, rel=1e-12)
    assert got["none", 0.5] == (0, None)


def test_quantiles_without_groups_or_rows(rows):
    df = rows([(float(i),) for i in range(11)], "v double")
    assert [(r.p, r.n, r.value) for r in quantiles.exact_quantiles(df, "v", [0.25]).collect()] == [(0.25, 11, float(np.quantile(range(11), 0.25)))]
    assert quantiles.exact_quantiles(rows([], "g string, v double"), "v", [0.5], ("g",)).count() == 0
