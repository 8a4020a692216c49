"""Numbers recorded for the sf0.01 views (FIXTURES.md section 2)."""

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from reelsight.operators import experiment, online
from reelsight.sources import testdata as td


def test_interactions_shape(spark):
    i = td.interactions(spark, SF01)
    row = i.agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("u"), F.min("ts").alias("lo"),
                F.max("ts").alias("hi"), F.count(F.when(F.col("rating") >= 3.5, 1)).alias("ge"),
                F.count(F.when(F.col("rating") > 3.5, 1)).alias("gt")).first()
    assert (row["n"], row["u"], row["lo"], row["hi"]) == (60000, 1500, 789004800, 1004832000)
    assert (row["ge"], row["gt"]) == (19068, 17810)


@pytest.mark.parametrize("h,succ,rate,active,proxy", [
    (600, 0, 0.0, 6, 0.0),
    (3600, 8, 0.004036, 46, 0.173913),
    (86400, 151, 0.076186, 701, 0.215407),
    (604800, 761, 0.383956, 1753, 0.434113),
])
def test_online_horizons(spark, h, succ, rate, active, proxy):
    r, w = td.responses(spark, SF01), td.watches(spark, SF01)
    s = online.online_summary(r, w, h).first()
    assert s["total_responses"] == 1982
    assert round(s["success_rate"], 6) == rate
    assert round(s["success_rate"] * 1982) == succ
    p = online.proxy_kpi(r, w, h).first()
    assert p["requests_with_watch"] == active and round(p["proxy_kpi"], 6) == proxy


def test_ab_counts(spark):
    lab = online.response_success(experiment.assign_arm(td.responses(spark, SF01)), td.watches(spark, SF01), 604800)
    got = {r["arm"]: (r["successes"], r["responses"]) for r in experiment.arm_rates(lab).collect()}
    assert got == {"A": (379, 1041), "B": (382, 941)}
