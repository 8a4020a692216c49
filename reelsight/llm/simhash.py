"""Near-duplicate detection by SimHash and multi-index hashing.

Fingerprints: 64 bits, each the majority of that bit over the XXH64 hashes
of the word shingles of the whole text.  Texts whose fingerprints differ in
at most ``max_bits`` bits are linked.

Links are found by multi-index hashing.  The 64 bits are cut into segments
with radii r_1..r_m such that sum(r_i + 1) = max_bits + 1: two fingerprints
within ``max_bits`` then agree in some segment i up to r_i bits, so no link
is lost.  Every distinct fingerprint is entered once per segment in a table
under its segment value; it looks up all values of the Hamming ball of radius
r_i around its own, and the full distance of every match is verified.  The
number of segments (2 to 4) is the one with the least expected work for the
number of distinct fingerprints; every choice is exact.

Large groups of near copies put thousands of fingerprints in one table
entry.  An entry whose look-ups times members exceed ``heavy`` is cut into
blocks of ``block`` look-ups and members; a block pair compares its at most
block x block distances in one vectorised step and returns only a spanning
forest of the links found (fewer than 2 x block rows), which leaves the
components the same without listing all pairs.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelsight.llm.components import components
from reelsight.llm.tables import packed, row_key, sorted_side, staged, unpacked

BITS = 64
SEED = 42
#: Shingles hashed at a time: bounds the memory of a very long text.
CHUNK = 1 << 16


def fingerprint(text: bytes, shingle: int) -> int:
    """The fingerprint of one whole text (UTF-8) as a signed 64-bit number."""
    import numpy as np
    import xxhash

    words = text.lower().split()  # bytes: A-Z only, and the six separators
    if not words:
        return 0
    joined = b" ".join(words)
    ends, at = [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    k = min(shingle, len(words))
    starts = [0] + [e + 1 for e in ends[:-1]]
    n = len(words) - k + 1
    ones = np.zeros(BITS, dtype=np.int64)
    view, digest = memoryview(joined), xxhash.xxh64_intdigest
    for lo in range(0, n, CHUNK):
        hi = min(n, lo + CHUNK)
        h = np.fromiter((digest(view[s:e], SEED) for s, e in zip(starts[lo:hi], ends[lo + k - 1:hi + k - 1])),
                        dtype="<u8", count=hi - lo)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > n, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, text: str = "text") -> DataFrame:
    """(doc_id, key, fp): the fingerprint of every row of ``docs``; ``key``
    names the row by its id and text.

    A null or blank text has fingerprint 0.  Repeated rows stay."""
    def run(batches):
        import pyarrow as pa

        for b in batches:
            fps = [fingerprint(t or b"", shingle) for t in b.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(fps, pa.int64())],
                                             names=["doc_id", "ka", "kb", "fp"])

    key = row_key(F.col("doc_id"), F.col(text))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), key.alias("k"), F.col(text).cast("binary").alias("t"))
    return (rows.select("doc_id", F.col("k.a").alias("ka"), F.col("k.b").alias("kb"), "t")
                .mapInArrow(run, "doc_id long, ka long, kb long, fp long"))


def layout(n: int, max_bits: int) -> list[tuple[int, int, int]]:
    """(shift, width, radius) of each segment with the least expected number
    of look-ups plus matches for ``n`` fingerprints."""
    best = None
    for m in range(2, 5):
        base, more = divmod(max_bits + 1, m)
        radii = [base + (i < more) - 1 for i in range(m)]
        if radii[-1] < 0:
            continue
        width = [BITS // m + (i < BITS % m) for i in range(m)]
        cost = sum(sum(comb(w, k) for k in range(r + 1)) * (1 + n / 2 ** w) for w, r in zip(width, radii))
        if best is None or cost < best[0]:
            shifts = [sum(width[:i]) for i in range(m)]
            best = (cost, list(zip(shifts, width, radii)))
    if best is None:  # max_bits 0: equal fingerprints only
        return [(0, 32, 0)]
    return best[1]


def _value(shift: int, width: int):
    return F.shiftrightunsigned(F.col("fp"), shift).bitwiseAND(F.lit((1 << width) - 1))


def _ball(width: int, radius: int) -> list[int]:
    return [sum(1 << i for i in c) for k in range(radius + 1) for c in combinations(range(width), k)]


def _forest(max_bits: int):
    """Spanning forest of the links between the look-ups and the members of
    one block pair."""
    def run(key, left, right):
        import numpy as np
        import pandas as pd

        a, b = left["fp"].to_numpy(np.uint64), right["fp"].to_numpy(np.uint64)
        ids = np.unique(np.concatenate([a, b]))
        ia, ib = np.searchsorted(ids, a), np.searchsorted(ids, b)
        tree = np.arange(len(ids))  # the tree each fingerprint is in so far
        out_a, out_b = [], []
        for i in range(len(a)):
            near = ib[np.bitwise_count(b ^ a[i]) <= max_bits]
            trees, at = np.unique(tree[near], return_index=True)
            own = tree[ia[i]]
            other = trees != own
            if other.any():
                out_b.append(ids[near[at[other]]])
                out_a.append(np.full(other.sum(), a[i], dtype=np.uint64))
                tree[np.isin(tree, trees[other])] = own
        if not out_a:
            return pd.DataFrame({"a": np.empty(0, np.int64), "b": np.empty(0, np.int64)})
        return pd.DataFrame({"a": np.concatenate(out_a).view(np.int64), "b": np.concatenate(out_b).view(np.int64)})

    return run


def links(fps: DataFrame, max_bits: int = 4, heavy: int = 10_000, block: int = 512) -> DataFrame:
    """(a, b): links between the distinct fingerprints ``fps`` (column fp),
    with the components of all pairs within ``max_bits`` (pairs in heavy
    entries as a spanning forest, all others in full)."""
    seg = layout(fps.count(), max_bits)
    member = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("seg"), _value(s, w).alias("val")) for i, (s, w, _) in enumerate(seg)])).alias("k")
    ).select("k.seg", "k.val", "fp")
    sizes = member.groupBy("seg", "val").agg(F.count(F.lit(1)).alias("members"))

    def near_values(i, shift, width, radius):
        flips = F.array(*[F.lit(m).cast("long") for m in _ball(width, radius)])
        return F.transform(flips, lambda m: F.struct(F.lit(i).alias("seg"),
                                                     _value(shift, width).bitwiseXOR(m).alias("val")))

    probe = fps.select("fp", F.explode(F.concat(*[near_values(i, *x) for i, x in enumerate(seg)])).alias("k")
                       ).select("k.seg", "k.val", "fp")
    found = staged(probe.join(sorted_side(sizes), ["seg", "val"]), "simhash-found")  # look-ups that meet an entry
    load = found.groupBy("seg", "val").agg(F.count(F.lit(1)).alias("lookups"), F.max("members").alias("members"))
    load = staged(load.where(F.col("members") > 1).unionByName(load.where("members = 1 and lookups > 1")),
                  "simhash-load")
    light = load.where(F.col("lookups") * F.col("members") <= heavy).select("seg", "val")
    dense = load.where(F.col("lookups") * F.col("members") > heavy).select(
        "seg", "val", F.ceil(F.col("lookups") / block).cast("int").alias("ln"),
        F.ceil(F.col("members") / block).cast("int").alias("mn"))

    f, m = found.select("seg", "val", F.col("fp").alias("a")), member.withColumnRenamed("fp", "b")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    pairs = (f.join(sorted_side(light), ["seg", "val"], "left_semi").join(sorted_side(m), ["seg", "val"])
              .where((F.col("a") < F.col("b")) & near).select("a", "b"))

    def dealt(side, own, other):
        """Each row in its own block, repeated for every block of the other side."""
        return (side.join(dense, ["seg", "val"])
                .withColumn("own", F.pmod(F.xxhash64("fp"), F.col(own)).cast("int"))
                .withColumn("other", F.explode(F.sequence(F.lit(0), F.col(other) - 1))))

    left = dealt(found.select("seg", "val", "fp"), "ln", "mn").select(
        "seg", "val", F.col("own").alias("i"), F.col("other").alias("j"), "fp")
    right = dealt(member, "mn", "ln").select(
        "seg", "val", F.col("other").alias("i"), F.col("own").alias("j"), "fp")
    keys = ["seg", "val", "i", "j"]
    forest = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(_forest(max_bits), "a long, b long")
    return pairs.unionByName(forest)


def _classes(docs: DataFrame, shingle: int, max_bits: int, text: str) -> tuple[DataFrame, DataFrame]:
    """The fingerprinted rows, and (_fp, root, component_id) of each
    distinct fingerprint."""
    rows = staged(fingerprints(docs, shingle, text), "simhash-fp")
    first = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    root = components(links(first.select("fp"), max_bits), "simhash-cc")
    named = first.join(root, first.fp == root.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    return rows, named.join(least, "root").select(F.col("fp").alias("_fp"), "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4, text: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``.

    ``component_id`` is the smallest doc_id reachable over links of at most
    ``max_bits`` differing fingerprint bits, the row itself included.  Null
    or blank texts have fingerprint 0 and are linked like any other; a null
    doc_id counts only where no linked row has an id (component_id is then
    null).  Repeated rows stay; an empty table gives no rows; other columns
    are not read."""
    rows, classes = _classes(docs, shingle, max_bits, text)
    return rows.join(classes, F.col("fp") == F.col("_fp")).select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, shingle: int = 4, max_bits: int = 4, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each component the row with the
    smallest doc_id (null last; of rows that repeat this id, the one whose
    content hash is least; of rows equal in id and text, any one).  Columns
    are those of ``docs``."""
    rows, classes = _classes(docs, shingle, max_bits, text)
    best = (rows.join(classes, F.col("fp") == F.col("_fp"))
                .groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "ka", "kb")).alias("k")))
    keep = best.select("k.ka", "k.kb")
    kept = packed(docs, row_key(F.col("doc_id"), F.col(text))).join(keep, ["ka", "kb"], "left_semi")
    return unpacked(kept.dropDuplicates(["ka", "kb"]), docs)
