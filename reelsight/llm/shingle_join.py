"""Jaccard join of shingle sets by partitioning the universe.

A document is the set of its distinct word shingles (64-bit hashes of three
words, say).  Two sets of sizes a and b with Jaccard similarity of at least
``num/den`` differ in at most (a + b)(den - num)/(den + num) shingles.  Sets are
dealt into size bands wide enough that a partner of a set is in its own band or
the one below.  For a band, a hash of the shingle cuts the universe into one
segment more than its sets and their partners can differ in, so of the subsets
that two similar sets have in the segments one at least is equal (pigeonhole).
The hash of each subset is indexed under its segment; sets are looked up in the
band below, too.

Allocation by cost.  A segment in which many sets have the same subset (few
shingles, or a very common one) costs many pairs.  It may be left out if another
segment answers for two differences: there the subsets' one-deletion
neighbourhoods are indexed as well, so subsets that differ by one shingle meet.
Counted over all sets, the dearest segments of each band are exchanged against
the cheapest of those that keep neighbourhoods, as long as that lowers the cost.
The units of a band always add up to its differences plus one: no exchange loses
a link.

Equal sets collapse first.  Every entry starts with a star: all members against
its least one.  Members of an entry that are then in different components meet a
star around another member, and what is still apart is compared pair by pair: in
small entries by a join, in large ones in blocks, where only pairs that parities
(below) leave possible become rows.  So a group of copies costs its members, not
its pairs, and no link between components is lost.

Verification is exact, on whole texts.  Before it, pairs that cannot be similar
are dropped by parities: every shingle flips one of 1,024 bits of its set, so two
sets differ in at least as many shingles as their parities in bits.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelsight.llm.components import components
from reelsight.llm.tables import row_key, staged

#: 64-bit words of a set's parities.
PARITY = 16
C1, C2, C3 = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9


@dataclass(frozen=True)
class Near:
    """Sets are linked if den * intersection >= num * union.  One in ``spare``
    segments of a band can hold neighbourhoods; ``swaps`` bounds the exchanges
    of a band, ``row_cost`` is the price of an index row in pairs, ``stars`` the
    number of rounds of stars; entries with more than ``heavy`` pairs are cut
    into blocks of ``block`` members."""
    shingle: int = 3
    num: int = 90
    den: int = 100
    spare: int = 16
    swaps: int = 64
    row_cost: float = 1.0
    stars: int = 2
    heavy: int = 1_000
    block: int = 512

    def differences(self, sizes: int) -> int:
        return sizes * (self.den - self.num) // (self.den + self.num)

    def least(self, n: int) -> int:
        """Size of the smallest partner."""
        return -(-n * self.num // self.den)

    def bands(self, longest: int) -> list[tuple[int, int, int]]:
        """(least size, largest size, segments) of each band; one segment
        means that only equal sets are similar."""
        out, lo = [], 1
        while lo <= longest:
            hi = lo * self.den // self.num * self.den // self.num
            out.append((lo, hi, self.differences(hi + hi * self.den // self.num) + 1))
            lo = hi + 1
        return out


def mixed(h):
    import numpy as np

    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: bytes, k: int):
    """The distinct shingles of a whole text (A-Z lower-cased), sorted; with
    fewer words than ``k`` the whole sequence is one."""
    import numpy as np
    import xxhash

    words = text.lower().split()  # bytes: A-Z only, and the six separators
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, count=len(words))
    k = min(k, len(words))
    out = np.full(len(words) - k + 1, k, np.uint64)
    for i in range(k):
        out = mixed(out * np.uint64(C1) + h[i:len(h) - k + 1 + i])
    return np.unique(out)


def signature(tokens, band: int, segments: int, spare: int):
    """The key of the subset in each segment; and keys and segments of the
    one-deletion neighbourhoods of the last segments."""
    import numpy as np

    at = (mixed(tokens + np.uint64(C3)) % np.uint64(segments)).astype(np.int64)
    sums = np.zeros(segments, np.uint64)
    np.add.at(sums, at, tokens)
    salt = np.arange(1, segments + 1, dtype=np.uint64) * np.uint64(C1) + np.uint64((band + 1) * C2 % 2 ** 64)
    first = segments - max(1, segments // spare)
    i = np.flatnonzero(at >= first)
    return (mixed(sums + salt).view(np.int64), mixed(sums[at[i]] - tokens[i] + salt[at[i]]).view(np.int64), at[i].astype(np.int32))


def parities(tokens):
    """The bits that an odd number of shingles flip."""
    import numpy as np

    bit = mixed(tokens ^ np.uint64(C3)) >> np.uint64(54)
    odd = np.bincount(bit.astype(np.int64), minlength=64 * PARITY) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def sets(docs: DataFrame, near: Near = Near(), text: str = "text") -> DataFrame:
    """doc_id, row key (ka, kb), n (set size), digest (d1, d2), parities, and for the
    own band and the one below (band -1: none) subset keys, neighbourhood keys
    and their segments; of every row."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        names = ["doc_id", "ka", "kb", "n", "d1", "d2", "parity", "band", "subsets", "dels", "del_seg", "low", "low_subsets", "low_dels", "low_del_seg"]
        longs, ints = pa.list_(pa.int64()), pa.list_(pa.int32())
        kinds = [pa.int64(), pa.int64(), pa.int64(), longs, pa.int32(), longs, longs, ints, pa.int32(), longs, longs, ints]
        none = (-1, [], [], [])
        bands: list = []

        def signed(tokens, g):
            return (g, *signature(tokens, g, bands[g][2], near.spare)) if g >= 0 and bands[g][2] > 1 else none

        for b in batches:
            rows = []
            for t in b.column(3):
                tokens = shingles(t.as_py() or b"", near.shingle)
                n = len(tokens)
                if not n:
                    rows.append((0, 0, 0, [], *none, *none))
                    continue
                if not bands or bands[-1][1] < n:
                    bands = near.bands(2 * n)
                g = next(i for i in range(len(bands)) if n <= bands[i][1])
                below = g - 1 if g and near.least(n) <= bands[g - 1][1] else -1
                d1 = tokens.sum(dtype=np.uint64).view(np.int64)
                d2 = mixed(tokens ^ np.uint64(C2)).sum(dtype=np.uint64).view(np.int64)
                rows.append((n, int(d1), int(d2), parities(tokens), *signed(tokens, g), *signed(tokens, below)))
            cols = list(zip(*rows)) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([*b.columns[:3], *[pa.array(c, k) for c, k in zip(cols, kinds)]], names=names)

    key = row_key(F.col("doc_id"), F.col(text))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), key.alias("k"), F.col(text).cast("binary").alias("t"))
    part = "{0}band int, {1}subsets array<long>, {1}dels array<long>, {1}del_seg array<int>"
    return rows.select("doc_id", F.col("k.a").alias("ka"), F.col("k.b").alias("kb"), "t").mapInArrow(
        run, "doc_id long, ka long, kb long, n long, d1 long, d2 long, parity array<long>, " + part.format("", "") + ", "
        + part.format("low_", "low_").replace("low_band", "low"))


def _entries(classes: DataFrame, subsets: bool) -> DataFrame:
    """(band, seg, key, rec, n, home): the subsets, or the neighbourhoods."""
    def side(band, keys, segs, home):
        pairs = F.transform(keys, lambda k, i: F.struct(i.alias("seg"), k.alias("key"))) if subsets else F.arrays_zip(
            segs.alias("seg"), keys.alias("key"))
        return (classes.where(F.col(band) >= 0)
                       .select(F.col(band).alias("band"), "rec", "n", F.lit(home).alias("home"), F.explode(pairs).alias("p"))
                       .select("band", "p.seg", "p.key", "rec", "n", "home"))

    name = "subsets" if subsets else "dels"
    return side("band", F.col(name), F.col("del_seg"), True).unionByName(
        side("low", F.col("low_" + name), F.col("low_del_seg"), False))


def allocation(classes: DataFrame, near: Near = Near()) -> list[tuple[int, int, int]]:
    """(band, segment left out, segment answering for two) of each exchange,
    at most ``swaps`` a band.

    The pairs of a segment are counted over all sets.  A neighbourhood is
    charged with its rows and with as many pairs again as its subsets have."""
    load = _entries(classes, True).groupBy("band", "seg", "key").agg(F.count(F.lit(1)).alias("f"))
    cost = load.groupBy("band", "seg").agg(F.sum(F.col("f") * (F.col("f") - 1) / 2).alias("pairs"), F.sum("f").alias("sets"))
    rows = _entries(classes, False).groupBy("band", "seg").agg(F.count(F.lit(1)).alias("rows"))
    t = cost.join(rows, ["band", "seg"], "left").withColumn("more", F.col("rows") * F.lit(near.row_cost) + F.col("pairs"))
    rank = lambda c: F.row_number().over(Window.partitionBy("band").orderBy(c, "seg"))
    # the segments of a band are as many as a text of its size allows, whatever the number of texts
    out = t.where("rows is null").select("band", F.col("seg").alias("skip"), "pairs", rank(F.col("pairs").desc()).alias("r"))
    two = t.where("rows is not null").select("band", F.col("seg").alias("two"), "more", rank(F.col("more").asc()).alias("r"))
    swaps = out.join(two, ["band", "r"]).where((F.col("r") <= near.swaps) & (F.col("pairs") > F.col("more")))
    return [tuple(r) for r in swaps.select("band", "skip", "two").collect()]


def _index(classes: DataFrame, near: Near) -> DataFrame:
    """(key, rec, n, home, whole): what is indexed under each key by the
    allocation; ``whole`` subsets, and neighbourhoods."""
    swaps = allocation(classes, near)
    spark = classes.sparkSession
    subsets, dels = _entries(classes, True), _entries(classes, False)
    # at most ``swaps`` rows a band, and bands grow with the logarithm of the longest text
    left_out = F.broadcast(spark.createDataFrame([(g, i) for g, i, _ in swaps], "band int, seg int"))
    doubled = F.broadcast(spark.createDataFrame([(g, j) for g, _, j in swaps], "band int, seg int"))
    return (subsets.join(left_out, ["band", "seg"], "left_anti").withColumn("whole", F.lit(True))
            .unionByName(dels.join(doubled, ["band", "seg"], "left_semi").withColumn("whole", F.lit(False)))
            .select("key", "rec", "n", "home", "whole"))


def verified(pairs: DataFrame, texts: DataFrame, near: Near = Near()) -> DataFrame:
    """The rows of ``pairs`` (a, b) whose texts (rec, t) are similar, by the
    exact intersection of their sets."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        last, held = None, None  # rows come in the order of b: its set is made once
        for batch in batches:
            keep = []
            for a, b, ta, tb in zip(*[batch.column(i) for i in range(4)]):
                if b.as_py() != last:
                    last, held = b.as_py(), shingles(tb.as_py() or b"", near.shingle)
                x = shingles(ta.as_py() or b"", near.shingle)
                both = len(np.intersect1d(x, held, assume_unique=True))
                keep.append(near.den * both >= near.num * (len(x) + len(held) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    t = texts.select(F.col("rec").alias("_r"), "t")
    first = pairs.join(t.withColumnRenamed("t", "ta"), F.col("a") == F.col("_r")).drop("_r")
    rows = first.join(t.withColumnRenamed("t", "tb"), F.col("b") == F.col("_r")).select("a", "b", "ta", "tb")
    return rows.mapInArrow(run, "a long, b long")


def _possible(pairs: DataFrame, classes: DataFrame, near: Near) -> DataFrame:
    """The distinct pairs (a, b) whose parities do not rule them out."""
    def side(name):
        return classes.select(F.col("rec").alias(name), F.col("n").alias(f"n{name}"), F.col("parity").alias(f"p{name}"))

    differ = F.aggregate(F.zip_with("pa", "pb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    most = F.floor((F.col("na") + F.col("nb")) * (near.den - near.num) / (near.den + near.num))
    return (pairs.select("a", "b").distinct().join(side("a"), "a").join(side("b"), "b")
                 .where(differ <= most).select("a", "b"))


def _compared(near: Near):
    """The pairs between two blocks of an entry that parities leave possible."""
    def run(left, right):
        import numpy as np
        import pyarrow as pa

        def columns(t):
            parity = np.asarray(t.column("parity").combine_chunks().flatten()).view(np.uint64).reshape(t.num_rows, -1)
            return [parity, *(np.asarray(t.column(c)) for c in ("rec", "n", "comp", "home", "whole"))]

        out_a, out_b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        if left.num_rows and right.num_rows:
            lp, lr, ln, lc, lh, lw = columns(left)
            rp, rr, rn, rc, rh, rw = columns(right)
            same = left.column("i")[0].as_py() == left.column("j")[0].as_py()
            for k in range(len(lr)):
                most = (rn + ln[k]) * (near.den - near.num) // (near.den + near.num)
                ok = (rc != lc[k]) & (rh | lh[k]) & (rw | lw[k]) & (np.bitwise_count(rp ^ lp[k]).sum(axis=1) <= most)
                if same:
                    ok &= rr > lr[k]
                out_a.append(np.maximum(rr[ok], lr[k]))
                out_b.append(np.minimum(rr[ok], lr[k]))
        return pa.table([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], names=["a", "b"])

    return run


def _in_blocks(rows: DataFrame, near: Near) -> DataFrame:
    """(a, b): the possible pairs of the entries of ``rows`` (key, f, rec, n,
    home, whole, comp, parity), block by block."""
    blocks = F.ceil(F.col("f") / near.block).cast("int")
    own = rows.withColumn("own", F.pmod(F.xxhash64("rec"), blocks).cast("int")).withColumn("blocks", blocks)
    cols = ["key", "rec", "n", "home", "whole", "comp", "parity"]
    left = own.select(*cols, F.col("own").alias("i"), F.explode(F.sequence("own", F.col("blocks") - 1)).alias("j"))
    right = own.select(*[F.col(c).alias(c) for c in cols], F.explode(F.sequence(F.lit(0), "own")).alias("i"), F.col("own").alias("j"))
    return left.groupBy("key", "i", "j").cogroup(right.groupBy("key", "i", "j")).applyInArrow(_compared(near), "a long, b long")


def _links(members: DataFrame, classes: DataFrame, texts: DataFrame, near: Near) -> DataFrame:
    """(rec, comp) of the sets that share a key with another, from (key, rec,
    n, home, whole)."""
    comp = staged(members.select("rec").distinct().withColumn("comp", F.col("rec")), "shingle-comp")
    fits = ((F.col("n") * near.den >= F.col("hn") * near.num) & (F.col("hn") * near.den >= F.col("n") * near.num))
    for i in range(near.stars + 1):
        # entries whose members are not all in one component yet
        named = members.join(comp, "rec")
        apart = named.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key")
        left = staged(named.join(apart, "key", "left_semi"), "shingle-apart")
        if i < near.stars:
            # the middle of the star: a whole subset of the band, another one each round
            order = F.struct((F.xxhash64("rec", F.lit(i)) if i else F.col("rec")).alias("o"), F.col("rec").alias("hub"),
                             F.col("n").alias("hn"), F.col("comp").alias("hc"))
            right = left.where("whole and home").groupBy("key").agg(F.min(order).alias("m")).select("key", "m.*")
            which = F.lit(True)
            several = left
        else:
            several = left.join(left.groupBy("key").agg(F.count(F.lit(1)).alias("f")), "key")
            dense = several.where(F.col("f") * F.col("f") > near.heavy)
            several = several.where(F.col("f") * F.col("f") <= near.heavy)
            right = several.select("key", F.col("rec").alias("hub"), F.col("n").alias("hn"), F.col("comp").alias("hc"),
                                F.col("home").alias("hh"), F.col("whole").alias("hw"))
            which = (F.col("rec") > F.col("hub")) & (F.col("whole") | F.col("hw")) & (F.col("home") | F.col("hh"))
        met = several.join(right, "key").where((F.col("comp") != F.col("hc")) & fits & which).select(
            F.greatest("rec", "hub").alias("a"), F.least("rec", "hub").alias("b"))
        if i == near.stars:
            parity = classes.select(F.col("rec").alias("_r"), "parity")
            met = met.unionByName(_in_blocks(dense.join(parity, F.col("rec") == F.col("_r")).drop("_r"), near))
        pairs = _possible(met, classes, near)
        found = verified(staged(pairs, "shingle-pairs"), texts, near)
        # components of components: only what the new links join
        names = comp.withColumnRenamed("rec", "r")
        joined = (found.join(names, found.a == names.r).select("b", F.col("comp").alias("ca"))
                       .join(names, F.col("b") == F.col("r")).select(F.col("ca").alias("a"), F.col("comp").alias("b")))
        root = components(joined, f"shingle-cc{i}")
        comp = staged(comp.join(root, comp.comp == root.node, "left").select("rec", F.coalesce("root", "comp").alias("comp")), "shingle-comp")
    return comp


def near_duplicates(docs: DataFrame, near: Near = Near(), text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``.

    ``component_id`` is the smallest doc_id reachable over links, the row's
    own included.  Null texts and texts without words have no shingles and no
    links; a null doc_id counts only where no linked row has an id
    (component_id is then null); repeated rows stay; an empty table gives no
    rows; other columns are not read."""
    rows = staged(sets(docs, near, text), "shingle-sets")
    # one row of each distinct set speaks for it
    mine = ["band", "subsets", "dels", "del_seg", "low", "low_subsets", "low_dels", "low_del_seg"]
    firsts = rows.where("n > 0").groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("first"), F.min(F.struct("ka", "kb")).alias("k"))
    named = staged(firsts.withColumn("rec", F.monotonically_increasing_id()), "shingle-classes")
    speak = named.select("rec", F.col("k.ka").alias("_a"), F.col("k.kb").alias("_b"))
    speaking = rows.where("band >= 0 or low >= 0").dropDuplicates(["ka", "kb"]).join(
        speak, (F.col("ka") == F.col("_a")) & (F.col("kb") == F.col("_b"))).select("rec", "n", "parity", *mine)
    classes = staged(speaking, "shingle-signed")
    index = _index(classes, near)
    shared = index.groupBy("key").agg(F.count(F.lit(1)).alias("f"), F.max(F.col("whole") & F.col("home")).alias("homes")).where("f > 1 and homes")
    members = staged(index.join(shared.select("key"), "key", "left_semi"), "shingle-members")
    wanted = members.select("rec").distinct().join(speak, "rec")
    key = row_key(F.col("doc_id"), F.col(text))
    whole = docs.select(key.alias("_k"), F.col(text).cast("binary").alias("t"))
    texts = staged(whole.join(wanted, (F.col("_k.a") == F.col("_a")) & (F.col("_k.b") == F.col("_b")))
                        .select("rec", "t").dropDuplicates(["rec"]), "shingle-texts")
    comp = _links(members, classes, texts, near)
    of = named.join(comp, "rec", "left").withColumn("comp", F.coalesce("comp", "rec"))
    least = of.groupBy("comp").agg(F.min("first").alias("component_id"))
    told = of.join(least, "comp").select(F.col("n").alias("_n"), F.col("d1").alias("_1"), F.col("d2").alias("_2"), "component_id")
    same = (F.col("n") == F.col("_n")) & (F.col("d1") == F.col("_1")) & (F.col("d2") == F.col("_2"))
    return rows.select("doc_id", "n", "d1", "d2").join(told, same, "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
