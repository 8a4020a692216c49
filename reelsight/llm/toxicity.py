"""Toxicity by cumulative-link ordinal regression on sparse text features.

A document has the features of its distinct words: the lower-cased word and
its first 4 to 7 letters (so that inflected forms share a feature), hashed to
``2 ** bits`` columns.  Columns whose documents' share of grades above 0 does
not differ from that of all documents by ``z`` standard errors, and those that
fewer than ``min_docs`` labelled documents hold, are left out.  Grades 0 < 1 < ... share one weight vector w, and
differ by ordered thresholds: P(grade <= k) = sigmoid(t_k - w x).  The score
is the expected grade, sum over k of P(grade > k).

Fitted on at most ``max_rows`` labelled documents (those with the least hash
of their id), whole texts.  Fitting takes one task whose memory that bound limits; text
features are made, and all documents scored, in parallel.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelsight.llm.tables import staged

WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Ordinal:
    bits: int = 20
    max_rows: int = 12_000
    min_docs: int = 3
    z: float = 5.0
    steps: int = 300
    rate: float = 0.1
    l2: float = 1e-2


def word_features(word: str, bits: int) -> tuple[int, ...]:
    """Columns of one lower-cased word."""
    parts = [word] + [f"{word[:n]}*" for n in (4, 5, 6, 7) if len(word) > n]
    return tuple(zlib.crc32(p.encode()) >> (32 - bits) for p in parts)


def features(text: str, bits: int, cache: dict) -> list[int]:
    """The distinct columns of a whole text, ascending."""
    out: set[int] = set()
    for w in set(WORD.findall(text.lower())):
        got = cache.get(w)
        if got is None:
            if len(cache) >= 500_000:  # only a short cut
                cache.clear()
            got = cache[w] = word_features(w, bits)
        out.update(got)
    return sorted(out)


def associated(rows: list, y, p: Ordinal):
    """(columns used, their lead): how many standard errors the mean of ``y``
    over a column's documents is from that over all."""
    import numpy as np

    size = 1 << p.bits
    idx = np.concatenate(rows)
    held = np.bincount(idx, minlength=size)
    graded = np.bincount(idx, weights=np.repeat(y, [len(r) for r in rows]), minlength=size)
    lead = (graded - held * y.mean()) / np.sqrt(np.maximum(held, 1) * y.var())
    used = np.flatnonzero((held >= p.min_docs) & (np.abs(lead) >= p.z))
    return used, lead[used]


def dose_grades(rows: list, toxic, p: Ordinal = Ordinal()):
    """Severity where labels only say toxic or not: 0 not toxic, 1 toxic, 2
    toxic with at least the toxic documents' median number of columns that
    lead to toxic."""
    import numpy as np

    y = np.asarray(toxic)
    if not len(y) or y.var() == 0:
        return y
    used, lead = associated(rows, y, p)
    dose = np.array([np.isin(r, used[lead > 0]).sum() for r in rows])
    return y + ((y == 1) & (dose >= max(1, np.median(dose[y == 1]))))


def fit(rows: list, grades, n_grades: int, p: Ordinal = Ordinal()):
    """({column: weight}, thresholds) by gradient steps on the likelihood;
    ``rows`` are arrays of columns."""
    import numpy as np

    y, m, size = np.asarray(grades), n_grades - 1, 1 << p.bits
    share = np.clip([(y <= k).mean() if len(y) else 1.0 for k in range(m)], 1e-3, 1 - 1e-3)
    t = np.maximum.accumulate(np.log(share / (1 - share)) + np.arange(m) * 1e-3)
    if not len(y) or (y > 0).var() == 0:
        return {}, t
    lens = np.array([len(r) for r in rows])
    idx, own = np.concatenate(rows), np.repeat(np.arange(len(rows)), lens)
    used, _ = associated(rows, (y > 0).astype(float), p)
    at = np.full(size, -1)
    at[used] = np.arange(len(used))
    idx = at[idx]
    idx, own = idx[idx >= 0], own[idx >= 0]
    w = np.zeros(len(used))
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -35, 35)))
    state = [np.zeros(len(used) + m), np.zeros(len(used) + m)]
    for step in range(1, p.steps + 1):
        z = np.bincount(own, weights=w[idx], minlength=len(y))
        # P(grade = y) = up - low, with up = P(<= y), low = P(<= y - 1)
        up = np.where(y < m, sig(t[np.minimum(y, m - 1)] - z), 1.0)
        low = np.where(y > 0, sig(t[np.maximum(y, 1) - 1] - z), 0.0)
        prob = np.maximum(up - low, 1e-9)
        dup, dlow = up * (1 - up) / prob, low * (1 - low) / prob
        gw = np.bincount(idx, weights=(dup - dlow)[own], minlength=len(used)) / len(y) + p.l2 * w / max(1, len(used))
        gt = np.zeros(m)
        np.add.at(gt, y[y < m], -dup[y < m])
        np.add.at(gt, y[y > 0] - 1, dlow[y > 0])
        g = np.concatenate([gw, gt / len(y)])
        state[0] = 0.9 * state[0] + 0.1 * g
        state[1] = 0.99 * state[1] + 0.01 * g * g
        move = p.rate * (state[0] / (1 - 0.9 ** step)) / (np.sqrt(state[1] / (1 - 0.99 ** step)) + 1e-8)
        w = w - move[:len(w)]
        t = np.maximum.accumulate(t - move[len(w):])
    return dict(zip(used.tolist(), w.tolist())), t


def model(docs: DataFrame, labels: DataFrame, n_grades: int | None = None, p: Ordinal = Ordinal(),
          text: str = "text") -> DataFrame:
    """(column, weight) of all columns used, and (-1 - k, threshold k).

    ``labels``: (doc_id, grade); ``n_grades`` None: grades are 0 and 1, and
    :func:`dose_grades` tells severe from other toxic documents.  Null ids or
    grades are left out, of repeated ids the highest grade counts.  Without usable labels the thresholds keep
    every document at grade 0."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col("grade").between(0, (n_grades or 2) - 1)).groupBy(
        F.col("doc_id").cast("long").alias("_id")).agg(F.max("grade").cast("int").alias("grade"))
    some = F.broadcast(staged(rows.orderBy(F.xxhash64("_id"), "_id").limit(p.max_rows), "toxic-sample"))  # max_rows rows

    def columns(batches: Iterator):
        import pyarrow as pa

        cache: dict = {}
        for b in batches:
            got = [features(t or "", p.bits, cache) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(got, pa.list_(pa.int32()))],
                                             names=["id", "grade", "cols"])

    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col(text).alias("t"))
    chosen = texts.join(some, texts.id == some["_id"]).select("id", "grade", "t")
    made = staged(chosen.mapInArrow(columns, "id long, grade int, cols array<int>")
                  .dropDuplicates(["id"]), "toxic-features")

    def train(t):
        import numpy as np
        import pyarrow as pa

        t = t.sort_by("id")
        cols = [np.asarray(c.values, dtype=np.int64) for c in t.column("cols").combine_chunks()]
        y = np.asarray(t.column("grade"))
        w, th = fit(cols, y, n_grades, p) if n_grades else fit(cols, dose_grades(cols, y, p), 3, p)
        return pa.table({"column": pa.array([*w, *(-1 - k for k in range(len(th)))], pa.int64()),
                         "weight": pa.array([*w.values(), *th], pa.float64())})

    return staged(made.groupBy(F.lit(0).alias("all")).applyInArrow(train, "column long, weight double"), "toxic-model")


def score(docs: DataFrame, weights: DataFrame, p: Ordinal = Ordinal(), text: str = "text") -> DataFrame:
    """(doc_id, severity, grade, toxic) of every row: the expected grade, the
    most likely one, and whether a grade above 0 is likelier than not.

    Null and empty texts have no features.  Repeated rows stay, null ids are
    passed on; an empty table gives no rows."""
    got = [(r["column"], r["weight"]) for r in weights.collect()]  # the columns used, and the thresholds
    w = {c: x for c, x in got if c >= 0}
    th = [x for c, x in sorted(got, reverse=True) if c < 0] or [50.0]
    sent = docs.sparkSession.sparkContext.broadcast((w, th))

    def run(batches: Iterator):
        import numpy as np
        import pyarrow as pa

        w, th = sent.value
        th, cache = np.array(th), {}

        def level(text: str) -> float:
            hit = set()
            for word in set(WORD.findall(text.lower())):
                cols = cache.get(word)
                if cols is None:
                    if len(cache) >= 500_000:  # only a short cut
                        cache.clear()
                    cols = cache[word] = tuple(c for c in word_features(word, p.bits) if c in w)
                if cols:
                    hit.update(cols)
            return sum(w[c] for c in sorted(hit))

        for b in batches:
            z = np.array([level(t or "") for t in b.column(1).to_pylist()])
            above = 1 / (1 + np.exp(-np.clip(z[:, None] - th[None, :], -35, 35)))  # P(grade > k)
            shares = np.hstack([np.ones((len(z), 1)), above]) - np.hstack([above, np.zeros((len(z), 1))])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(above.sum(axis=1)), pa.array(shares.argmax(axis=1), pa.int32()),
                 pa.array(above[:, 0] > 0.5)], names=["doc_id", "severity", "grade", "toxic"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("t")).mapInArrow(
        run, "doc_id long, severity double, grade int, toxic boolean")
