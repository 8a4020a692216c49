"""Approximate nearest neighbours with a hash-prefix forest.

A tree is a sorted array of long hash strings: the signs of ``bits`` random
projections of each vector, as one number.  A query descends in every tree
to the vectors with the longest common prefix, then all trees ascend together,
one bit of prefix less at a time, until at least the wanted number of different
candidates is reached; those are scored exactly.

Signs of projections know angles only, and the wanted is the inner product.  So
the rows of a chunk are cut into bands of similar length, and within a band,
whose longest vector has length M, a vector x is hashed as (x, sqrt(M*M - |x|*|x|))
and a query as (q, 0): all hashed rows are of length M, and the angle falls as
the inner product grows.  Scores use the vectors themselves.

The vectors are dealt by id into chunks of about ``chunk`` rows, each of which
holds one forest; the queries, in blocks of ``block``, visit every chunk, and
the best of all chunks are merged.  So a vector is stored once whatever the
number of trees, no prefix that many vectors share can fill a task, and memory
is bounded by a chunk and a block.  The candidates wanted of a band are
``share`` of its rows, and ``least`` times k rows of a chunk, the longest first, at least.  Vectors without any structure (independent directions
in 64 dimensions) need over half of the rows for a recall above 0.9 with any sign
hash; vectors in clusters need far less.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelsight.llm.tables import staged


@dataclass(frozen=True)
class Forest:
    trees: int = 24
    bits: int = 32
    share: float = 0.6
    least: int = 10
    chunk: int = 16_384
    block: int = 4_096
    seed: int = 7
    #: Lengths within a band differ by this factor at most.
    spread: float = 1.25


def usable(vec: Column) -> Column:
    """Not null, not zero, all components finite."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vec, lambda x: x != 0), F.lit(False))


class Trees:
    """The forest of one band of a chunk."""

    def __init__(self, x, forest: Forest):
        import numpy as np

        self.x, self.f = x, forest
        rng = np.random.default_rng(forest.seed)
        self.planes = np.concatenate([rng.normal(size=(forest.trees, x.shape[1], forest.bits)),
                                      rng.normal(size=(forest.trees, 1, forest.bits))], axis=1)
        squares = (x * x).sum(axis=1)
        rest = np.sqrt(squares.max(initial=0.0) - squares)[:, None]
        self.order, self.codes = [], []
        for p in self.planes:
            c = self.hash(x, p, rest)
            o = np.argsort(c, kind="stable")
            self.order.append(o)
            self.codes.append(c[o])
        self.mask = np.zeros(len(x), dtype=bool)

    def hash(self, x, plane, rest=0.0):
        """The signs of (x, rest); a query has no rest."""
        import numpy as np

        weights = np.left_shift(np.uint64(1), np.arange(self.f.bits - 1, -1, -1, dtype=np.uint64))
        return ((x @ plane[:-1] + rest * plane[-1:]) > 0).astype(np.uint64) @ weights

    def candidates(self, q):
        """For each query, the rows met when the trees have ascended far
        enough."""
        import numpy as np

        bits, n = self.f.bits, len(self.x)
        want = min(n, max(self.f.least, int(np.ceil(self.f.share * n))))
        codes = [self.hash(q, p) for p in self.planes]

        def ranges(level, rows):
            """Per tree, where each query's prefix of ``level`` bits lies."""
            cut = np.uint64(bits - level)
            out = []
            for c, have in zip(codes, self.codes):
                low = (c[rows] >> cut) << cut
                high = low + (np.uint64(1) << cut)
                out.append((np.searchsorted(have, low), np.searchsorted(have, high)))
            return out

        open_, got = np.arange(len(q)), {}
        for level in range(bits, -1, -1):
            if not len(open_):
                break
            r = ranges(level, open_)
            met = sum(hi - lo for lo, hi in r)  # with repeats: an upper bound
            left = np.ones(len(open_), dtype=bool)
            for k in np.flatnonzero(met >= want):
                self.mask[:] = False
                for (lo, hi), o in zip(r, self.order):
                    self.mask[o[lo[k]:hi[k]]] = True
                found = np.flatnonzero(self.mask)
                if len(found) >= want or level == 0:
                    got[open_[k]] = found
                    left[k] = False
            open_ = open_[left]
        return got


def bands(x, spread: float):
    """Row numbers of ``x`` by length: in each band within a factor of
    ``spread`` of the longest one."""
    import numpy as np

    top = np.abs(x).max(axis=1)
    size = np.log(top) + np.log(np.sqrt(((x / top[:, None]) ** 2).sum(axis=1)))  # without overflow
    left = np.argsort(-size, kind="stable")
    while len(left):
        n = int(np.searchsorted(-size[left], np.log(spread) - size[left[0]], side="right"))
        yield np.sort(left[:n])
        left = left[n:]


def candidates(x, q, forest: Forest, k: int):
    """For each query, the rows of one chunk met in the forests of its bands."""
    import numpy as np

    met: list[list] = [[] for _ in range(len(q))]
    least = forest.least * k  # goes to the longest vectors first
    for rows in bands(x, forest.spread):
        part = replace(forest, least=least)
        least = max(0, least - len(rows))
        mine = x if len(rows) == len(x) else x[rows]
        # to length 1 at most: squares of hashed vectors neither overflow nor vanish
        for i, found in Trees(mine / np.abs(mine).max(), part).candidates(q).items():
            met[i].append(rows[found])
    return {i: np.sort(np.concatenate(found)) for i, found in enumerate(met) if found}


def best(x, ids, q, q_ids, k: int, forest: Forest):
    """(query id, id, score) of the k best candidates of one chunk."""
    import numpy as np

    out_q, out_i, out_s = [], [], []
    for i, found in candidates(x, q, forest, k).items():
        found = found[ids[found] != q_ids[i]]
        if not len(found):
            continue
        rough = x[found] @ q[i]
        if len(found) > k:
            # all that may be among the k best, whatever the last digits
            edge = np.partition(rough, -k)[-k]
            found = found[rough >= edge - 1e-9 * max(1.0, abs(edge))]
        score = (x[found] * q[i]).sum(axis=1)  # equal vectors get equal scores
        top = np.lexsort((ids[found], -score))[:k]
        out_q.append(np.full(len(top), q_ids[i]))
        out_i.append(ids[found][top])
        out_s.append(score[top])
    if not out_q:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    return np.concatenate(out_q), np.concatenate(out_i), np.concatenate(out_s)


def search(base: DataFrame, queries: DataFrame, k: int = 20, forest: Forest = Forest(),
           vec: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of ``base`` with the
    largest inner product found for each of ``queries``, nearest first, ties
    to the smaller vec_id; rank counts from 1.

    Vectors that are null, zero, or hold a null or non-finite component, and
    rows without an id take no part.  Vectors of each number of components are
    searched by themselves.  Rows with a query's own id are no candidates for
    it; other rows that share an id are candidates each.  Of queries that share
    an id, the one whose vector hashes least counts.  A query with fewer than
    ``k`` candidates gets them all; empty tables give no rows."""
    def ready(df: DataFrame) -> DataFrame:
        d = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vec).cast("array<double>").alias("v"))
        return d.where(F.col("vec_id").isNotNull() & usable(F.col("v"))).withColumn("d", F.size("v"))

    b = staged(ready(base), "forest-base")
    one = ready(queries).groupBy("vec_id").agg(F.min_by(F.struct("v", "d"), F.xxhash64("v")).alias("r"))
    q = staged(one.select("vec_id", "r.*"), "forest-queries")
    chunks, blocks = max(1, -(-b.count() // forest.chunk)), max(1, -(-q.count() // forest.block))
    deal = lambda m, salt: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(m)).cast("int")
    left = b.withColumn("chunk", deal(chunks, "chunk")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = q.withColumn("block", deal(blocks, "block")).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))

    def run(left, right):
        import numpy as np
        import pyarrow as pa

        def matrix(t):
            col = t.column("v").combine_chunks()
            flat = np.asarray(col.flatten(), dtype=np.float64) if len(col) else np.empty(0)
            return flat.reshape(len(col), -1) if len(col) else np.empty((0, 0))

        names = ["query_id", "vec_id", "score"]
        kinds = [pa.int64(), pa.int64(), pa.float64()]
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], t) for t in kinds], names=names)
        got = best(matrix(left), np.asarray(left.column("vec_id")), matrix(right), np.asarray(right.column("vec_id")), k, forest)
        return pa.table([pa.array(c, t) for c, t in zip(got, kinds)], names=names)

    keys = ["d", "chunk", "block"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        run, "query_id long, vec_id long, score double")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
