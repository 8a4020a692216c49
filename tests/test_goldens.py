"""Hand-checked values (FIXTURES.md section 3) on tiny frames."""

import math

import pytest
from pyspark.sql import functions as F

from reelsight.functions.exprs import parse_movie_ids
from reelsight.operators import clean, drift, experiment, ranking, recommend, registry, splits
from reelsight.operators.online import online_summary, response_success


def test_drift_two_values_vs_shift(spark):
    ref = spark.createDataFrame([(1,)] * 50 + [(2,)] * 50, "user_id int")
    cur = spark.createDataFrame([(9,)] * 100, "user_id int")
    e = drift.bin_edges(ref, ["user_id"]).first()
    assert e["edges_psi"] == [1.0, 1.5, 2.0]
    m = drift.drift_metrics(ref, cur, ["user_id"]).first()
    assert m["psi"] == pytest.approx(13.122337132677574, rel=1e-12)
    assert m["kl"] == pytest.approx(13.122363377404328, rel=1e-12)


def test_drift_single_value(spark):
    ref = spark.createDataFrame([(10,)] * 100, "user_id int")
    cur = spark.createDataFrame([(99,)] * 100, "user_id int")
    assert drift.bin_edges(ref, ["user_id"]).first()["edges_psi"] == [9.5, 10.5]
    m = drift.drift_metrics(ref, cur, ["user_id"]).first()
    assert m["psi"] == pytest.approx(13.815496742453716, rel=1e-12)
    assert m["kl"] == pytest.approx(13.815510557964274, rel=1e-12)


def test_histogram_last_bin_closed_and_outside_dropped(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 99, 3)], "x double")
    b = df.select(drift._bin_index(F.col("x"), F.array(*[F.lit(float(v)) for v in (1, 2, 3)])).alias("b"))
    counts = sorted((r["b"], r["n"]) for r in b.where("b is not null").groupBy("b").agg(F.count("*").alias("n")).collect())
    assert counts == [(0, 1), (1, 3)]


def test_no_drift_is_zero(spark):
    ref = spark.createDataFrame([(1, 10, 4.0), (2, 11, 3.0), (3, 12, 5.0), (4, 13, 2.0)],
                                "user_id int, movie_id int, rating double")
    m = drift.detect_drift(ref, ref).collect()
    assert all(r["psi"] == 0.0 and r["kl"] == 0.0 and not r["drift"] for r in m)


def _metrics(spark, recs, truth, k, **kw):
    r = spark.createDataFrame([(1, i + 1, x) for i, x in enumerate(recs)], "uidx int, rank int, iidx int")
    t = spark.createDataFrame([(1, x, 1) for x in truth], "uidx int, iidx int, copies int")
    return ranking.user_metrics(r, t, [k], **kw).first()


def test_ndcg_map_precision(spark):
    assert _metrics(spark, [1, 2, 3], [2], 3)["ndcg"] == pytest.approx(0.6309297535714575)
    m = _metrics(spark, [1, 2, 3], [1, 3], 3)
    assert m["ndcg"] == pytest.approx(0.9197207891481876)
    assert m["map"] == pytest.approx(0.8333333333333333)
    assert _metrics(spark, [1, 2, 3], [1, 3], 5)["precision"] == pytest.approx(0.4)
    assert _metrics(spark, [1, 2, 3], [1, 3], 5, precision_denominator="returned")["precision"] == \
        pytest.approx(2 / 3)


def test_ztest(spark):
    rates = spark.createDataFrame([("A", 30, 100), ("B", 20, 100)], "arm string, successes long, responses long")
    z = experiment.z_test(rates).first()
    assert z["z"] == pytest.approx(1.6329931618554523, rel=1e-12)
    assert z["p_two_sided"] == pytest.approx(0.10247043485974938, abs=1e-6)
    rates0 = spark.createDataFrame([("A", 0, 2), ("B", 0, 4)], "arm string, successes long, responses long")
    z0 = experiment.z_test(rates0).first()
    assert (z0["z"], z0["p_two_sided"]) == (0.0, 1.0)
    ci = experiment.bootstrap_ci(rates0, 200).first()
    assert (ci["ci_lo"], ci["ci_hi"]) == (0.0, 0.0)


def test_percentile_is_linear(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 4, 8, 16, 16, 3.5)], "x double")
    p = df.select(F.percentile("x", F.array(*[F.lit(q) for q in (0.0, 0.1, 0.5, 0.95, 1.0)]))).first()[0]
    assert p == pytest.approx([1.0, 1.6, 4.0, 16.0, 16.0])


def test_holdout_tie_goes_to_earliest_row(spark):
    df = spark.createDataFrame([(1, "a", 5, 0), (1, "b", 9, 1), (1, "c", 9, 2)],
                               "uidx int, iidx string, timestamp int, row int")
    train, test = splits.last_item_holdout(df, ["row"])
    assert test.first()["true_item"] == "b"
    assert sorted(r["iidx"] for r in train.collect()) == ["a", "c"]


def test_basic_clean_parity_clips_ids(spark):
    df = spark.createDataFrame([("1", "2", "5", 10, 0), (None, "3", "bad", 11, 1), ("77", "4", "9", 12, 2)],
                               "user_id string, item_id string, rating string, timestamp long, row int")
    out = sorted(tuple(r) for r in clean.basic_clean(df, ["row"], clip_ids=True)
                 .select("user_id", "rating").collect())
    assert out == [(0, 0.0), (1, 5.0), (5, 5.0)]
    default = clean.basic_clean(df, ["row"])
    assert sorted(r["user_id"] for r in default.collect()) == [1, 77]


def test_basic_clean_keeps_last_duplicate(spark):
    df = spark.createDataFrame([("1", "2", "1", 10, 0), ("1", "2", "4", 10, 1)],
                               "user_id string, item_id string, rating string, ts long, row int")
    out = clean.basic_clean(df, ["row"]).collect()
    assert len(out) == 1 and out[0]["rating"] == 4.0 and "timestamp" in out[0].asDict()


def test_fallback_without_model(spark):
    req = spark.createDataFrame([(7,)], "user_id int")
    row = recommend.recommend_fallback(req, None, None, 3).first()
    assert row["items"] == [50, 172, 1] and row["source"] == "fallback"


def test_factor_norm_rank(spark):
    f = spark.createDataFrame([(101, [1.0, 0.0]), (202, [0.1, 1.2])], "item int, features array<float>")
    r = sorted((x["rank"], x["item"], round(x["norm"], 4)) for x in recommend.factor_norm_rank(f).collect())
    assert r == [(1, 202, 1.2042), (2, 101, 1.0)]


def test_next_version_is_numeric(spark):
    reg = spark.createDataFrame([(f"v0.{i}",) for i in range(1, 11)], "version string")
    row = registry.next_version(reg).first()
    assert row["latest"] == "v0.10" and row["next_version"] == "v0.11" and row["text_latest"] == "v0.9"
    empty = registry.next_version(reg.limit(0)).first()
    assert empty["next_version"] == "v1.0"


@pytest.mark.parametrize("text,expected", [
    ("[1, 2]", [1, 2]), ('{"movie_ids":[3]}', [3]), ("[4;5|6 7]", [4, 5, 6, 7]), ("", []), (None, []),
    ('"5"', [5]), ("12", []), ('{"a": 1}', []), ('[1, "2", 2.7, "x"]', [1, 2, 2]), ("1,2 3", [1, 2, 3]),
])
def test_parse_movie_ids(spark, text, expected):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(parse_movie_ids("s")).first()[0] == expected


def test_interval_bounds_inclusive(spark):
    h = 600
    resp = spark.createDataFrame([(1, 1, 1000, [5]), (2, 2, 1000, [5]), (3, 3, 1000, [5]), (4, 4, 1000, [5])],
                                 "request_id int, user_id int, ts long, movie_ids array<bigint>")
    wat = spark.createDataFrame([(1, 1000, 5), (2, 1000 + h, 5), (3, 999, 5), (4, 1001 + h, 5)],
                                "user_id int, ts long, movie_id bigint")
    s = {r["request_id"]: r["success"] for r in response_success(resp, wat, h).collect()}
    assert s == {1: 1, 2: 1, 3: 0, 4: 0}


def test_online_summary_empty_latency(spark):
    resp = spark.createDataFrame([(1, 1, 0, [1], None)],
                                 "request_id int, user_id int, ts long, movie_ids array<bigint>, latency_ms double")
    wat = spark.createDataFrame([], "user_id int, ts long, movie_id bigint")
    row = online_summary(resp, wat, 60).first()
    assert row["success_rate"] == 0.0 and row["latency_p50"] is None


def test_map_k_zero_is_zero(spark):
    assert _metrics(spark, [1, 2], [1], 0)["map"] == 0.0
    assert math.isfinite(_metrics(spark, [1, 2], [1], 0)["precision"])
