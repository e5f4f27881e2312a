"""Selection against sorted values: signs, ties, NULLs, odd and even groups,
values that differ in their last bits only."""

from __future__ import annotations

import random
from fractions import Fraction

from punctual.operators.quantiles import exact_quantiles


def want(values, p):
    v = sorted(values)
    at = Fraction(p * (len(v) - 1), 100)
    low = v[at.__floor__()]
    return float(low + (v[at.__ceil__()] - low) * (at - at.__floor__()))


def test_selection_equals_sorting(spark):
    rng, data = random.Random(6), []
    for g, n, size in (("a", 1, 9), ("b", 2, 10 ** 15), ("c", 101, 5), ("d", 200, 2 ** 62), (None, 33, 10 ** 9), ("e", 50, 1)):
        data += [(g, rng.choice([1, -1]) * rng.randrange(size) if g != "e" else 7 * 10 ** 17) for _ in range(n)]
    data += [("near", 5 * 10 ** 12 + i) for i in range(40)] + [("a", None), ("nothing", None)]
    df = spark.createDataFrame(data, "g string, v long")
    percents = [0, 10, 50, 99, 100]
    got = {r.g: [r[f"p{p}"] for p in percents] for r in exact_quantiles(df, ["g"], "v", percents).collect()}
    groups = {g for g, v in data if v is not None}
    assert got == {g: [want([v for h, v in data if h == g and v is not None], p) for p in percents] for g in groups}
    one = exact_quantiles(df.where("g = 'near'"), [], "v", [50], 43).collect()
    assert [tuple(r) for r in one] == [(want([v for h, v in data if h == "near"], 50),)]
    assert exact_quantiles(df.where("false"), ["g"], "v", [50]).count() == 0
