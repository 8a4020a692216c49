"""Collaborative filtering with MLlib ALS (REC1-REC4, REC8, SNK4).

Training data is the long interaction table; MLlib's blocked ALS never
materialises a user x item matrix.  Top-k lists come from exact scoring pruned
by factor lengths (:mod:`reelsight.operators.topk`).  Users who came after
training are folded in against the item factors.
"""

from __future__ import annotations

import math

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelsight.operators.topk import top_lists, top_products
from reelsight.session import checkpoint_dir, materialize, swept

# The reference's ALS configuration.
FACTORS, REG, ITERS, THRESHOLD = 64, 0.01, 20, 3.5

#: Blocks of users and of items at least; factors that reach a block in a half
#: step (about 200 MB at rank 64); ratings from which every iteration is checkpointed.
BLOCKS, RECEIVED, LARGE = 10, 750_000, 1_000_000


def ui_matrix(train: DataFrame, threshold: float = THRESHOLD, op: str = ">", user: str = "uidx",
              item: str = "iidx") -> DataFrame:
    """Long user x item matrix: value = number of positive rows
    (rating > threshold); duplicates sum, non-positives stay as explicit 0
    cells (REC1)."""
    pos = F.col("rating") > threshold if op == ">" else F.col("rating") >= threshold
    v = pos.cast("double") if "rating" in train.columns else F.lit(1.0)
    return train.groupBy(user, item).agg(F.sum(v).alias("value"))


def blocks_for(ratings: int, others: int) -> int:
    """Blocks of users (or items) for so many ratings of ``others`` items (or
    users).  A half step gathers in each block's task the factors of all the
    others that the block's ratings name, so more blocks need less memory;
    but each block gets its own copy, so there are no more than needed."""
    if others <= RECEIVED:
        return BLOCKS
    # of random ratings n / blocks, this share of the others is named: 1 - exp(-n / (blocks * others))
    return max(BLOCKS, math.ceil(ratings / (others * -math.log1p(-RECEIVED / others))))


def train_als(ui: DataFrame, rank: int = FACTORS, reg: float = REG, iters: int = ITERS, alpha: float = 1.0,
              seed: int | None = 42, user: str = "uidx", item: str = "iidx", blocks: int | None = None) -> ALSModel:
    """Implicit-feedback ALS (REC2).  Zero cells carry no preference in
    Spark's formulation (confidence 1, preference 0 = unobserved), so only
    positive cells are fitted.  Lineage is cut every 5 iterations (large
    tables: every iteration) through the shared checkpoint folder, and the
    files of shuffles that no factors hang on any more are removed meanwhile;
    so the disks hold one or two iterations, not all."""
    checkpoint_dir(ui.sparkSession)
    data = materialize(ui.where(F.col("value") > 0).select(F.col(user).cast("int").alias(user),
                                                           F.col(item).cast("int").alias(item), "value"), "als-ratings")
    n, users, items = data.agg(F.count(F.lit(1)), F.approx_count_distinct(user), F.approx_count_distinct(item)).first()
    als = ALS(rank=rank, regParam=reg, maxIter=iters, alpha=alpha, implicitPrefs=True,
              userCol=user, itemCol=item, ratingCol="value", coldStartStrategy="drop",
              nonnegative=False, checkpointInterval=1 if n >= LARGE else 5,
              numUserBlocks=blocks or blocks_for(n, items), numItemBlocks=blocks or blocks_for(n, users))
    if seed is not None:
        als = als.setSeed(seed)
    with swept(ui.sparkSession):
        return als.fit(data)


def recommend_serving(model: ALSModel, users: DataFrame, k: int, user: str = "uidx", item: str = "iidx",
                      lists: bool = False) -> DataFrame:
    """Top-k by factor dot product, seen items not excluded (REC4); users the
    model does not know get none, and k beyond the catalogue gives all of it.

    (user, rank, item, score), or with ``lists`` (user, rank, items, scores) as
    :func:`reelsight.operators.topk.top_lists` returns them: for lists of the
    whole catalogue, whose entries are as many as the pairs."""
    wanted = users.select(F.col(user).alias("id")).distinct()
    known = model.userFactors.join(wanted, "id", "left_semi")
    if lists:
        return top_lists(known, model.itemFactors, k, user, item)
    return top_products(known, model.itemFactors, k, None, user, item)[0]


def _gram(items: DataFrame) -> list[list[float]]:
    """Sum of the outer products of all item factors: one matrix for each
    task, added up entry by entry; only its rank x rank sums reach the driver."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        total = 0
        for b in batches:
            v = np.array(b.column(0).to_pylist(), dtype=np.float64)
            total = total + v.T @ v if len(v) else total
        if not np.isscalar(total):
            yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.float64()))], names=["g"])

    parts = items.select(F.col("features").cast("array<double>").alias("v")).mapInArrow(run, "g array<double>")
    sums = [r["x"] for r in parts.select(F.posexplode("g").alias("p", "x")).groupBy("p").agg(F.sum("x").alias("x")).orderBy("p").collect()]
    n = math.isqrt(len(sums))
    return [sums[i * n:(i + 1) * n] for i in range(n)]


def _partial(gram: list[list[float]], alpha: float, reg: float):
    """The normal equations of some chunks of ratings: solved at once for a
    user of one chunk, else their upper triangle."""
    def run(t):
        import numpy as np
        import pyarrow as pa

        t = t.sort_by([("u", "ascending"), ("part", "ascending")])
        v = np.array(t.column("v").combine_chunks().flatten(), dtype=np.float64).reshape(t.num_rows, -1)
        r, u, part, chunks = (np.asarray(t.column(c)) for c in ("value", "u", "part", "chunks"))
        first = np.flatnonzero(np.r_[True, (u[1:] != u[:-1]) | (part[1:] != part[:-1])])
        ids, solved, rest, base = [], [], [], np.array(gram)
        for lo, hi in zip(first, [*first[1:], len(u)]):
            y, c, liked = v[lo:hi], alpha * np.abs(r[lo:hi]), r[lo:hi] > 0
            a, b, n = (y * c[:, None]).T @ y, ((1 + c) * liked) @ y, float(liked.sum())
            one = chunks[lo] == 1
            ids.append(u[lo])
            solved.append(np.linalg.solve(base + a + reg * n * np.eye(len(b)), b) if one else None)
            rest.append(None if one else np.concatenate([a[np.triu_indices(len(b))], b, [n]]))
        return pa.table({"id": pa.array(ids, pa.int64()), "features": pa.array(solved, pa.list_(pa.float64())),
                         "sums": pa.array(rest, pa.list_(pa.float64()))})

    return run


def _solved(gram: list[list[float]], reg: float):
    def run(t):
        import numpy as np
        import pyarrow as pa

        d = len(gram)
        s = np.asarray(t.sort_by("p").column("x"), dtype=np.float64)
        up = np.triu_indices(d)
        a = np.zeros((d, d))
        a[up] = s[:len(up[0])]
        a = a + np.triu(a, 1).T
        x = np.linalg.solve(np.array(gram) + a + reg * s[-1] * np.eye(d), s[len(up[0]):-1])
        return pa.table({"id": t.column("id")[:1], "features": pa.array([x], pa.list_(pa.float64()))})

    return run


#: Ratings of a user whose normal equations are made in one task.
CHUNK = 4096


def fold_in(ui: DataFrame, items: DataFrame, reg: float = REG, alpha: float = 1.0, user: str = "uidx", item: str = "iidx",
            chunk: int = CHUNK) -> DataFrame:
    """(id, features) of users against fixed item factors (REC2, REC8): the
    half step of implicit ALS for users who came after training.

    ``ui`` is (user, item, value), a pair once; ``items`` (id, features).  The
    factors solve (G + sum c y y' + reg n I) x = sum (1 + c) y over the user's
    items, c = alpha |value|, with positive values in the right side and in n,
    and G the Gram matrix of all items, made once.  A training user gets the
    factors that training gave it.  Users without a known item with a positive
    value have no row.

    A user's ratings are dealt into chunks of about ``chunk``; the normal
    equations of several chunks are added up entry by entry, so a user with
    ratings of the whole catalogue is no larger group than others."""
    gram = _gram(items)
    spark = ui.sparkSession
    if not gram:
        return spark.createDataFrame([], "id long, features array<double>")
    y = items.select(F.col("id").cast("long").alias("i"), F.col("features").cast("array<double>").alias("v"))
    rated = ui.select(F.col(user).cast("long").alias("u"), F.col(item).cast("long").alias("i"), F.col("value").cast("double").alias("value"))
    rows = rated.where("value is not null and u is not null").join(y, "i")
    sizes = rated.join(y.select("i"), "i", "left_semi").groupBy("u").agg(
        F.count(F.lit(1)).alias("n"), F.max("value").alias("most")).where("most > 0")
    sizes = materialize(sizes.select("u", "n", F.ceil(F.col("n") / chunk).alias("chunks")), "fold-in-users")
    # users of one chunk are dealt into groups of about a chunk of ratings, too
    groups = max(1, (sizes.where("chunks = 1").agg(F.sum("n")).first()[0] or 0) // chunk)
    dealt = rows.join(sizes.drop("n"), "u").withColumn("part", F.pmod(F.xxhash64("i"), F.col("chunks")))
    group = F.when(F.col("chunks") == 1, F.pmod(F.xxhash64("u"), F.lit(groups))).otherwise(F.xxhash64("u", "part"))
    made = materialize(dealt.groupBy(group.alias("g")).applyInArrow(
        _partial(gram, alpha, reg), "id long, features array<double>, sums array<double>"), "fold-in")
    parts = made.where("sums is not null").select("id", F.posexplode("sums").alias("p", "x")).groupBy("id", "p").agg(F.sum("x").alias("x"))
    many = parts.groupBy("id").applyInArrow(_solved(gram, reg), "id long, features array<double>")
    return made.where("sums is null").select("id", "features").unionByName(many)


def top_unseen(users: DataFrame, items: DataFrame, seen: DataFrame, k: int, user: str = "uidx",
               item: str = "iidx") -> DataFrame:
    """(user, rank, item, score): the ``k`` unseen items with the largest
    factor product for each user; ties to the smaller item id.  ``users`` and
    ``items`` are (id, features); see :mod:`reelsight.operators.topk`."""
    return top_products(users, items, k, seen, user, item)[0]


def recommend_unseen(model: ALSModel, users: DataFrame, seen: DataFrame, k: int,
                     user: str = "uidx", item: str = "iidx") -> DataFrame:
    """Top-k unseen items of every user the model knows (REC3)."""
    wanted = users.select(F.col(user).alias("id")).distinct()
    return top_unseen(model.userFactors.join(wanted, "id", "left_semi"), model.itemFactors, seen, k, user, item)


def recommend_hybrid(cf: DataFrame, popular: DataFrame, user: str = "uidx") -> DataFrame:
    """CF lists for users the model scored, popularity lists for the rest
    (REC8).  Both inputs are ``(user, rank, item)``."""
    scored = cf.select(user).distinct()
    fallback = popular.join(scored, user, "left_anti")
    cols = [user, "rank", *[c for c in popular.columns if c not in (user, "rank", "pos")]]
    return (cf.select(*cols).withColumn("source", F.lit("cf"))
              .unionByName(fallback.select(*cols).withColumn("source", F.lit("popularity"))))


def factor_table(model: ALSModel) -> DataFrame:
    """User and item factors in one table ``(kind, id, features)``."""
    return (model.userFactors.select(F.lit("user").alias("kind"), "id", "features")
                 .unionByName(model.itemFactors.select(F.lit("item").alias("kind"), "id", "features")))


def finite_features(features: str = "features"):
    return F.forall(F.col(features), lambda x: ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))


def publish(model: ALSModel, registry_dir: str, version: str, metrics: dict[str, float],
            extra: dict[str, str] | None = None) -> DataFrame:
    """Save the model under ``registry_dir/models/<version>`` and append its
    registry row with a sha256 over the saved files (SNK4)."""
    from reelsight.sources.sinks import publish_metadata
    path = f"{registry_dir.rstrip('/')}/models/{version}"
    model.write().overwrite().save(path)
    return publish_metadata(model.userFactors.sparkSession, f"{registry_dir.rstrip('/')}/table", version, path,
                            metrics, extra)
