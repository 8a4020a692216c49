"""A/B experiment readout (EXP1-EXP8).

Arm assignment, per-arm success counts, the pooled two-proportion z-test,
a parametric bootstrap of the rate difference and the ship decision.  The
statistics work on per-arm counts (one aggregate over the log), so their
cost does not grow with the number of responses beyond that one pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelsight.functions.exprs import hash_uniform, normal_cdf
from reelsight.session import materialize

ALPHA = 0.05


def assign_arm(df: DataFrame, user: str = "user_id", override: str | None = None,
               arm_a: str = "A", arm_b: str = "B") -> DataFrame:
    """Even user ids -> arm A, odd -> arm B; a non-empty override column
    wins (EXP1)."""
    parity = F.when(F.pmod(F.col(user), F.lit(2)) == 0, F.lit(arm_a)).otherwise(F.lit(arm_b))
    if override and override in df.columns:
        o = F.col(override)
        parity = F.when(o.isNotNull() & (o != ""), o).otherwise(parity)
    return df.withColumn("arm", parity)


def ab_responses(requests: DataFrame, recs_by_arm: dict[str, DataFrame], provenance: dict[str, str],
                 model_versions: dict[str, str], user: str = "user_id", item: str = "item_id") -> DataFrame:
    """Attach each request's list from its arm's recommender and the
    provenance columns (EXP2).  ``recs_by_arm`` maps arm -> ``(user, rank,
    item)``; the per-user list is at most k long, so collecting it is
    bounded by k."""
    lists = None
    for arm, recs in recs_by_arm.items():
        l_ = (recs.groupBy(user)
                  .agg(F.sort_array(F.collect_list(F.struct("rank", F.col(item).cast("bigint").alias("i"))))
                       .alias("_l"))
                  .select(user, F.lit(arm).alias("arm"), F.transform("_l", lambda x: x["i"]).alias("movie_ids")))
        lists = l_ if lists is None else lists.unionByName(l_)
    mv = F.create_map(*[x for a, v in model_versions.items() for x in (F.lit(a), F.lit(v))])
    out = requests.join(lists, [user, "arm"], "left")
    return out.select("*", mv[F.col("arm")].alias("model_version"),
                      *[F.lit(v).alias(k) for k, v in provenance.items()])


def arm_rates(labelled: DataFrame, success: str = "success") -> DataFrame:
    """successes, responses and rate per arm (EXP3)."""
    return (labelled.groupBy("arm")
                    .agg(F.sum(F.col(success)).cast("bigint").alias("successes"),
                         F.count(F.lit(1)).alias("responses"))
                    .withColumn("rate", F.col("successes") / F.col("responses")))


def _counts(rates: DataFrame, arm_a: str, arm_b: str) -> DataFrame:
    g = lambda arm, c: F.sum(F.when(F.col("arm") == arm, F.col(c)).otherwise(0))
    return rates.agg(g(arm_a, "successes").alias("succ_a"), g(arm_a, "responses").alias("n_a"),
                     g(arm_b, "successes").alias("succ_b"), g(arm_b, "responses").alias("n_b"))


def z_columns(sa: Column, na: Column, sb: Column, nb: Column) -> tuple[Column, Column, Column, Column]:
    """Pooled two-proportion z-test: (z, p two-sided, p greater, p less);
    se = 0 -> (0, 1, 1, 1) (EXP4)."""
    pool = (sa + sb) / (na + nb)
    se = F.sqrt(pool * (1 - pool) * (F.lit(1.0) / na + F.lit(1.0) / nb))
    z = (sa / na - sb / nb) / se
    zero = (se == 0) | se.isNull()
    zc = F.when(zero, F.lit(0.0)).otherwise(z)
    two = F.when(zero, F.lit(1.0)).otherwise(2 * (1 - normal_cdf(F.abs(z))))
    greater = F.when(zero, F.lit(1.0)).otherwise(1 - normal_cdf(z))
    less = F.when(zero, F.lit(1.0)).otherwise(normal_cdf(z))
    return zc, two, greater, less


def z_test(rates: DataFrame, arm_a: str = "A", arm_b: str = "B") -> DataFrame:
    c = _counts(rates, arm_a, arm_b)
    z, two, greater, less = z_columns(F.col("succ_a"), F.col("n_a"), F.col("succ_b"), F.col("n_b"))
    return c.select("*", z.alias("z"), two.alias("p_two_sided"), greater.alias("p_greater"),
                    less.alias("p_less"),
                    (F.col("succ_a") / F.col("n_a") - F.col("succ_b") / F.col("n_b")).alias("delta"))


#: Standard deviations around the mean that a binomial table covers; what is
#: outside has a probability below 1e-30.
REACH = 12


def binomial_table(c: DataFrame, successes: str, n: str) -> DataFrame:
    """(k, cdf) of Binomial(n, successes / n) for the one row of ``c``.

    The probabilities follow from the ratios of neighbours, added up as
    logarithms from the lower end and scaled to 1; the table has about
    ``2 * REACH`` standard deviations of rows."""
    p = F.col(successes) / F.col(n)
    sd = F.sqrt(F.col(n) * p * (1 - p))
    lo = F.greatest(F.lit(0), F.floor(F.col(successes) - REACH * sd - REACH)).cast("long")
    hi = F.least(F.col(n), F.ceil(F.col(successes) + REACH * sd + REACH)).cast("long")
    inner = (F.col(successes) > 0) & (F.col(successes) < F.col(n))
    ks = c.where(F.col(n) > 0).select(successes, n, F.explode(F.when(inner, F.sequence(lo, hi)).otherwise(
        F.array(F.col(successes).cast("long")))).alias("k"), F.when(inner, lo).otherwise(F.col(successes)).alias("lo"))
    ratio = F.when(F.col("k") == F.col("lo"), F.lit(0.0)).otherwise(
        F.log((F.col(n) - F.col("k") + 1) / F.col("k") * (p / (1 - p))))
    up = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    logs = ks.select("k", F.sum(ratio).over(up).alias("l"))
    weight = logs.select("k", F.exp(F.col("l") - F.max("l").over(Window.partitionBy())).alias("w"))
    return weight.select("k", (F.sum("w").over(up) / F.sum("w").over(Window.partitionBy())).alias("cdf"))


def binomial_draws(table: DataFrame, replicates: int, seed: int, tag: str) -> DataFrame:
    """(rep, k): for each replicate the smallest k whose cdf reaches a hashed
    uniform: an exact inverse draw.  Draws and table are merged by value;
    both are bounded (replicates, table rows)."""
    u = F.lit(1.0) - hash_uniform(seed, F.lit(tag), F.col("rep"))
    reps = table.sparkSession.range(1, int(replicates) + 1).select(F.col("id").cast("int").alias("rep"))
    both = reps.select(u.alias("v"), "rep", F.lit(None).cast("long").alias("k"), F.lit(1).alias("kind")).unionByName(
        table.select(F.col("cdf").alias("v"), F.lit(None).cast("int").alias("rep"), "k", F.lit(0).alias("kind")))
    down = Window.orderBy(F.desc("v"), "kind").rowsBetween(Window.unboundedPreceding, 0)
    top = table.select(F.max("k")).scalar()  # a uniform above the last, rounded cdf
    return both.withColumn("k", F.coalesce(F.min("k").over(down), top)).where("kind = 1").select("rep", "k")


def bootstrap_ci(rates: DataFrame, replicates: int = 2000, seed: int = 42, alpha: float = ALPHA,
                 arm_a: str = "A", arm_b: str = "B") -> DataFrame:
    """Percentile CI of the rate difference from a parametric bootstrap:
    each replicate redraws both arms' successes from Binomial(n, rate)
    (EXP5).  The cost depends on the replicates, not on the log size."""
    c = materialize(_counts(rates, arm_a, arm_b), "ab-counts")  # one row
    n = c.first()
    draw = lambda s, m, tag: binomial_draws(binomial_table(c, s, m), replicates, seed, tag)
    a = draw("succ_a", "n_a", "a").withColumnRenamed("k", "ka")
    b = draw("succ_b", "n_b", "b").withColumnRenamed("k", "kb")
    d = a.join(b, "rep").select(F.try_divide(F.col("ka").cast("double"), F.lit(n["n_a"])).alias("ra"),
                                F.try_divide(F.col("kb").cast("double"), F.lit(n["n_b"])).alias("rb"))
    # the differences of all replicates are a bounded list
    pct = F.percentile(F.col("ra") - F.col("rb"), F.array(F.lit(alpha / 2), F.lit(1 - alpha / 2)))
    return d.agg(pct[0].alias("ci_lo"), pct[1].alias("ci_hi"), F.count(F.lit(1)).alias("replicates"))


def decision(p: Column, lo: Column, hi: Column, alpha: float = ALPHA) -> Column:
    """Ship A / ship B / inconclusive (EXP6)."""
    return (F.when((p < alpha) & (lo > 0), F.lit("ship A"))
             .when((p < alpha) & (hi < 0), F.lit("ship B"))
             .otherwise(F.lit("inconclusive")))


def provenance_trace(responses: DataFrame, n: int = 3, seed: int = 42, key: str = "request_id") -> DataFrame:
    """A deterministic sample of ``n`` responses for a provenance trace
    (EXP7): the ``n`` smallest seeded hashes of the key."""
    return (responses.withColumn("_h", hash_uniform(seed, key))
                     .orderBy("_h", key).limit(n).drop("_h"))
