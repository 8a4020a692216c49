"""Merged quantile sketches against sorted values."""

import numpy as np
from pyspark.sql import functions as F

from reelsight.operators import sketches as sk


def test_any_range_of_days(spark):
    rng = np.random.default_rng(1)
    rows = [(f"2024-01-{d + 1:02d}", float(x), None if i % 7 else float("nan")) for d in range(6)
            for i, x in enumerate(rng.lognormal(size=3000) * (d + 1))]
    rows += [(None, 1.0, 1.0), ("2024-01-02", None, 3.0)]
    df = spark.createDataFrame(rows, "day string, x double, y double")
    daily = sk.daily_sketches(df, F.col("day"), ["x", "y"]).cache()
    assert {(r["day"], r["column"]): r["n"] for r in daily.collect() if r["column"] == "x"} == {(f"2024-01-{d + 1:02d}", "x"): 3000 for d in range(6)}
    for lo, hi in ((1, 6), (2, 4), (5, 5)):
        got = sk.quantiles(sk.merged(daily, f"2024-01-{lo:02d}", f"2024-01-{hi:02d}"), [0.01, 0.3, 0.5, 0.9, 0.999])
        v = np.sort([x for d, x, _ in rows if d and x is not None and f"2024-01-{lo:02d}" <= d <= f"2024-01-{hi:02d}"])
        for r in got.where("column = 'x'").collect():
            assert r["n"] == len(v)
            assert (v < r["value"]).mean() - sk.rank_error() <= r["level"] <= (v <= r["value"]).mean() + sk.rank_error()
    one = sk.bin_edges(sk.merged(daily, "2024-01-01", "2024-01-06"), 10).collect()
    assert {r["column"]: len(r["edges"]) for r in one} == {"x": 11, "y": 2}
    assert [r["edges"] for r in one if r["column"] == "y"] == [[2.5, 3.5]]
    assert sk.merged(daily, "2025-01-01", "2025-01-02").collect() == []
    daily.unpersist()
