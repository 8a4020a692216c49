"""Distribution drift: quantile bin edges, PSI, KL and a drift report
(DRF1-DRF5).

All columns are handled in one pass: edges come from the counts of the
distinct values (one scan, at most 21 numbers for each column), and bin counts
are one ``groupBy`` whose partial aggregation collapses the rows map-side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelsight.operators.common import exact_quantiles

# Default thresholds, bin counts and the zero-share floor.
THRESHOLDS = {"psi": 0.2, "kl": 0.5}
PSI_BINS, KL_BINS = 10, 20
FLOOR = 1e-6
DEFAULT_COLUMNS = ("user_id", "movie_id", "rating")


def quantile_levels(bins: int) -> list[float]:
    """``0, 1/bins, ..., 1`` computed like ``numpy.linspace``."""
    step = 1.0 / bins
    return [i * step for i in range(bins)] + [1.0]


def _long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    present = [c for c in columns if c in df.columns]
    if not present:
        return df.sparkSession.createDataFrame([], "column string, value double")
    return (df.select(*[F.col(c).cast("double").alias(c) for c in present])
              .unpivot([], present, "column", "value")
              .where(F.col("value").isNotNull() & ~F.isnan("value")))


def bin_edges(ref: DataFrame, columns: Sequence[str] = DEFAULT_COLUMNS) -> DataFrame:
    """Per column: ``edges_psi`` (10 bins) and ``edges_kl`` (20 bins) from the
    unique reference quantiles; fewer than 2 -> ``[v - 0.5, v + 0.5]``
    (DRF1).  All columns and levels come from one scan."""
    present = [c for c in columns if c in ref.columns]
    lp, lk = quantile_levels(PSI_BINS), quantile_levels(KL_BINS)
    levels = sorted(set(lp) | set(lk))
    rows = []
    for c, vals in exact_quantiles(ref, present, levels).items():
        if vals is not None:
            at = dict(zip(levels, vals))
            rows.append((c, _unique_edges([at[q] for q in lp]), _unique_edges([at[q] for q in lk])))
    return ref.sparkSession.createDataFrame(rows, "column string, edges_psi array<double>, edges_kl array<double>")


def _unique_edges(values: list[float]) -> list[float]:
    e = sorted(set(values))
    if len(e) < 2:
        v = e[0] if e else 0.0
        return [v - 0.5, v + 0.5]
    return e


def _bin_index(value: Column, edges: Column) -> Column:
    """numpy.histogram bin: half-open bins, last bin closed, outside -> null."""
    m = F.size(edges) - 1
    i = F.size(F.filter(edges, lambda e: e <= value)) - 1
    return F.when(value == F.element_at(edges, -1), m - 1).when((i >= 0) & (i < m), i)


def _bin_case(value: Column, edges: list[float]) -> Column:
    """The bin index of :func:`_bin_index` as a literal CASE chain (compiled
    by whole-stage codegen, unlike a per-row lambda over the edge array)."""
    m = len(edges) - 1
    expr = F.when(value == F.lit(edges[-1]), F.lit(m - 1))
    expr = expr.when((value > F.lit(edges[-1])) | (value < F.lit(edges[0])), F.lit(None).cast("int"))
    for i in range(m - 1, -1, -1):
        expr = expr.when(value >= F.lit(edges[i]), F.lit(i))
    return expr


def bin_shares(ref: DataFrame, cur: DataFrame, edges: DataFrame,
               columns: Sequence[str] = DEFAULT_COLUMNS) -> DataFrame:
    """Per (column, kind, bin): reference and current shares with the
    zero floor applied; ``kind`` is ``psi`` or ``kl``.

    The edge table has one row per column (at most 21 numbers each), so it
    is read to the driver and turned into literal CASE expressions; one pass
    over both frames then counts every (column, kind, bin)."""
    spark = ref.sparkSession
    e = {r["column"]: (list(r["edges_psi"]), list(r["edges_kl"])) for r in edges.collect()}
    sides = (_long(ref, columns).withColumn("side", F.lit("ref"))
             .unionByName(_long(cur, columns).withColumn("side", F.lit("cur"))))
    psi_bin, kl_bin = F.lit(None).cast("int"), F.lit(None).cast("int")
    for c, (ep, ek) in e.items():
        psi_bin = F.when(F.col("column") == c, _bin_case(F.col("value"), ep)).otherwise(psi_bin)
        kl_bin = F.when(F.col("column") == c, _bin_case(F.col("value"), ek)).otherwise(kl_bin)
    counted = (sides.groupBy("column", "side", psi_bin.alias("psi"), kl_bin.alias("kl"))
                    .agg(F.count(F.lit(1)).alias("n")))
    binned = (counted.select("column", "side", "n", F.explode(F.array(
                  F.struct(F.lit("psi").alias("kind"), F.col("psi").alias("bin")),
                  F.struct(F.lit("kl").alias("kind"), F.col("kl").alias("bin")))).alias("b"))
                     .select("column", "side", "n", "b.kind", "b.bin")
                     .where(F.col("bin").isNotNull()))
    counts = (binned.groupBy("column", "kind", "bin")
                    .agg(F.sum(F.when(F.col("side") == "ref", F.col("n")).otherwise(0)).alias("ref_n"),
                         F.sum(F.when(F.col("side") == "cur", F.col("n")).otherwise(0)).alias("cur_n")))
    grid = spark.createDataFrame([(c, k, b) for c, (ep, ek) in e.items()
                                  for k, ed in (("psi", ep), ("kl", ek)) for b in range(len(ed) - 1)],
                                 "column string, kind string, bin int")
    full = (grid.join(counts, ["column", "kind", "bin"], "left")
                .fillna(0, ["ref_n", "cur_n"]))
    tot = full.groupBy("column", "kind").agg(F.sum("ref_n").alias("ref_t"), F.sum("cur_n").alias("cur_t"))
    share = lambda n, t: F.col(n) / F.greatest(F.col(t), F.lit(1))
    floor = lambda c: F.when(c == 0, F.lit(FLOOR)).otherwise(c)
    return (full.join(tot, ["column", "kind"])
                .select("column", "kind", "bin", "ref_n", "cur_n",
                        floor(share("ref_n", "ref_t")).alias("r"), floor(share("cur_n", "cur_t")).alias("c")))


def drift_metrics(ref: DataFrame, cur: DataFrame, columns: Sequence[str] = DEFAULT_COLUMNS) -> DataFrame:
    """Per column present on both sides: ``psi`` (DRF2) and ``kl`` (DRF3)."""
    both = [c for c in columns if c in ref.columns and c in cur.columns]
    edges = bin_edges(ref, both)
    sh = bin_shares(ref, cur, edges, both)
    term = F.when(F.col("kind") == "psi", (F.col("c") - F.col("r")) * F.log(F.col("c") / F.col("r"))) \
            .otherwise(F.col("r") * F.log(F.col("r") / F.col("c")))
    return (sh.groupBy("column")
              .agg(F.sum(F.when(F.col("kind") == "psi", term)).alias("psi"),
                   F.sum(F.when(F.col("kind") == "kl", term)).alias("kl")))


def detect_drift(ref: DataFrame, cur: DataFrame, columns: Sequence[str] = DEFAULT_COLUMNS,
                 thresholds: dict[str, float] | None = None) -> DataFrame:
    """Metrics per column plus ``drift`` = any psi > limit or kl > limit (DRF4)."""
    lim = thresholds or THRESHOLDS
    m = drift_metrics(ref, cur, columns)
    flagged = m.withColumn("flag", (F.col("psi") > lim["psi"]) | (F.col("kl") > lim["kl"]))
    any_flag = flagged.select(F.coalesce(F.bool_or("flag"), F.lit(False))).scalar()
    return flagged.withColumn("drift", any_flag)


def drift_table(ref: DataFrame, cur: DataFrame, columns: Sequence[str] = DEFAULT_COLUMNS,
                thresholds: dict[str, float] | None = None) -> DataFrame:
    """Report rows for every requested column, 6 decimals; a column missing
    on either side gives nulls (DRF5)."""
    lim = thresholds or THRESHOLDS
    spark = ref.sparkSession
    wanted = spark.createDataFrame([(c, i) for i, c in enumerate(columns)], "column string, ord int")
    m = drift_metrics(ref, cur, columns)
    return (wanted.join(m, "column", "left")
                  .select("column", F.round("psi", 6).alias("psi"), F.round("kl", 6).alias("kl"),
                          F.lit(lim["psi"]).alias("psi_threshold"), F.lit(lim["kl"]).alias("kl_threshold"),
                          ((F.col("psi") > lim["psi"]) | (F.col("kl") > lim["kl"])).alias("flag")))
