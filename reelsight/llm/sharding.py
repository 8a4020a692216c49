"""Consistent-hash sharding with virtual nodes and bounded loads.

Each shard has ``vnodes`` virtual nodes at hashed places on a ring; a row
belongs to the shard of the first virtual node clockwise of its own place,
the hash of its key.  A shard holds at most its capacity,
(1 + slack) * rows / shards (with slack 0: rows / shards, the remainder one
each to the first shards).  Rows of a full shard, the last ones of the ring
first, continue clockwise to the next virtual node whose shard has room.

Rows are ranked in their home shard once, in ring order; how many rows of each
arc overflow and where they go follows from the row counts of the arcs alone,
which is a table of shards * vnodes rows whatever the input.  That table
gives, for each shard, ranges of ranks and the shard and first slot they get.

Only DataFrame functions are used.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from hashlib import md5

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelsight.llm.tables import running, staged


@dataclass(frozen=True)
class Ring:
    shards: int = 16
    vnodes: int = 64
    slack: float = 0.0
    seed: str = "ring"

    def place(self, name: str) -> int:
        """Where a name lies on the ring of 2**52 places."""
        return int(md5(f"{self.seed}|{name}".encode()).hexdigest()[:13], 16)

    def arcs(self) -> list[tuple[int, int]]:
        """(place, shard) of all virtual nodes in ring order; places differ."""
        at: dict[int, int] = {}
        for s in range(self.shards):
            for v in range(self.vnodes):
                p = self.place(f"shard {s} node {v}")
                while p in at:
                    p = (p + 1) % (1 << 52)
                at[p] = s
        return sorted(at.items())

    def capacities(self, rows: int) -> list[int]:
        if self.slack:
            return [-int(-rows * (1 + self.slack) // self.shards)] * self.shards
        return [rows // self.shards + (s < rows % self.shards) for s in range(self.shards)]


def flow(arc_shard: list[int], counts: list[int], caps: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(home, first rank, end rank, shard, first slot) of all rows, given the
    shard and the row count of each arc in ring order.

    Home rows keep their rank as slot up to the capacity.  The others leave
    from their arc, in ring order, and fill the room of the next shards
    clockwise."""
    shards = len(caps)
    home = [0] * shards
    for s, c in zip(arc_shard, counts):
        home[s] += c
    out = [(s, 0, min(home[s], caps[s]), s, 0) for s in range(shards) if min(home[s], caps[s])]
    used = [min(h, c) for h, c in zip(home, caps)]
    seen = [0] * shards
    n = len(arc_shard)
    for i, (s, c) in enumerate(zip(arc_shard, counts)):
        lo, hi = max(seen[s], caps[s]), seen[s] + c
        seen[s] += c
        step = 1
        while lo < hi and step < n:
            to = arc_shard[(i + step) % n]
            take = min(hi - lo, caps[to] - used[to])
            if take > 0:
                out.append((s, lo, lo + take, to, used[to]))
                used[to] += take
                lo += take
            step += 1
        assert lo >= hi, "capacities are below the number of rows"
    return out


def assign(docs: DataFrame, ring: Ring = Ring(), key: str = "doc_id", keep: list | None = None) -> DataFrame:
    """The ``keep`` columns (names or Columns; default the key) of every row,
    with shard (int) and slot (long, gapless from 0 in each shard).

    Rows with equal keys start at one place and spread clockwise as shards
    fill; a null key is hashed like a value of its own.  Which of several
    rows equal in key and in all of ``keep`` gets which slot is not fixed.
    An empty table gives no rows."""
    arcs = ring.arcs()
    cols = [F.col(c) if isinstance(c, str) else c for c in (keep or [key])]
    name = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    place = F.conv(F.substring(F.md5(F.concat(F.lit(f"{ring.seed}|key "), name)), 1, 13), 16, 10).cast("long")
    rows = docs.select(*cols, place.alias("_place"), place.cast("double").alias("_x"))
    # arc i: after the place of node i - 1, up to that of node i; past the last one the ring starts again
    cuts = [float(p) + 1 for p, _ in arcs]
    rows = Bucketizer(splits=[float("-inf"), *cuts, float("inf")], inputCol="_x", outputCol="_b").transform(rows)
    n = len(arcs)
    shard_of = F.array(*[F.lit(s) for _, s in arcs])
    arc = F.when(F.col("_b") >= n, 0).otherwise(F.col("_b").cast("int"))
    names = [c for c in rows.columns if c not in ("_x", "_b", "_place")]
    # _turn: rows past the last node come first in arc 0
    rows = rows.select(*names, "_place", (F.col("_b") < n).cast("int").alias("_turn"), arc.alias("_arc")).withColumn(
        "_home", F.get(shard_of, F.col("_arc")))
    rows = staged(running(rows, ["_home"], ["_arc", "_turn", "_place", *names], None, "ring-rows", out="_rank"), "ring-ranked")
    got = {r["_arc"]: r["n"] for r in rows.groupBy("_arc").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most n rows
    counts = [got.get(i, 0) for i in range(n)]
    moves = flow([s for _, s in arcs], counts, ring.capacities(sum(counts)))
    by_home: list[list] = [[] for _ in range(ring.shards)]
    for home, lo, hi, to, slot in moves:
        by_home[home].append({"lo": lo, "hi": hi, "to": to, "slot": slot})
    # a constant of a few hundred ranges; a row picks the one that holds its rank
    table = F.from_json(F.lit(json.dumps(by_home)), "array<array<struct<lo:bigint,hi:bigint,to:int,slot:bigint>>>")
    ranges = F.get(table, F.col("_home"))
    pick = F.get(F.filter(ranges, lambda r: (r["lo"] <= F.col("_rank")) & (F.col("_rank") < r["hi"])), F.lit(0))
    return rows.withColumn("_p", pick).select(
        *names, F.col("_p.to").alias("shard"), (F.col("_p.slot") + F.col("_rank") - F.col("_p.lo")).alias("slot"))
