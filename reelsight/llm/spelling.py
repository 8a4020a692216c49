"""Spelling variants by reduced alphabets.

Words are counted over whole texts.  Every letter is hashed to one of a few
symbols, so a word becomes a short string over a small alphabet (its reduced
word), and the full one-edit neighbourhood of a reduced word is small enough to
be generated: the word itself, every deletion, every replacement by another
symbol and every insertion of a symbol.  Two words that differ by one edit have
reduced words that differ by one edit at most, so a join of the neighbourhoods
with the table of reduced words meets every pair; each is then verified on the
original strings.

Sizes.  The number of symbols depends on the length of the word looked for:
the least with ``room`` times as many possible reduced words as there are words
of that length, so the words that share a reduced word stay few however large
the vocabulary is.  A neighbourhood towards another length uses the alphabet of
that length.  Symbols are dealt to letters by frequency, so each is about as
common as the others.

The neighbourhood relation is symmetric.  Each of its edges is generated at one
end only: a deletion at the longer word (which is the insertion seen from the
shorter one), a replacement at the word with the smaller symbol.  The pairs found
are read in both directions.

Reduced words and their neighbours are 64-bit polynomial hashes (a hash that two
reduced words share only adds a candidate), computed for all words of a length at
once; a word meets another at most once.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass
from itertools import islice

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelsight.llm.tables import staged

#: [A-Za-zÀ-ÿ]+ in the bytes of a lower-cased text
RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
BASE = 0x9E3779B97F4A7C15
#: Runs of a text that are looked at together, and words held before they are passed on.
CHUNK, HELD = 1 << 16, 1 << 17


@dataclass(frozen=True)
class Variants:
    """``noise``: of the runs hashed by document, one in ``noise`` loses a
    letter.  Words have at least ``min_length`` letters and ``min_count``
    occurrences.  A form occurs ``factor`` times as often as its variants."""
    noise: int = 31
    min_length: int = 7
    min_count: int = 2
    factor: int = 10
    room: int = 8


def run_words(doc_id: int | None, runs: Counter, how: Variants) -> Counter:
    """The words of the runs of a document, long enough ones only."""
    start = zlib.crc32(b"%s:" % (b"null" if doc_id is None else str(doc_id).encode()))
    out: Counter = Counter()
    for run, n in runs.items():
        h = zlib.crc32(run, start)
        if h % how.noise == 0:
            letters = run.decode()
            at = h % len(letters)
            run = (letters[:at] + letters[at + 1:]).encode()
        if len(run) >= how.min_length and (run.isascii() or len(run.decode()) >= how.min_length):
            out[run] += n
    return out


def vocabulary(docs: DataFrame, how: Variants = Variants(), text: str = "text") -> DataFrame:
    """(word, n, id) of every distinct word, written once.

    Words are added up within a task before they are shuffled."""
    def run(batches):
        import pyarrow as pa

        def passed(counts):
            return pa.RecordBatch.from_arrays([pa.array([w.decode() for w in counts], pa.string()),
                                               pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

        held: Counter = Counter()
        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                found = RUN.finditer((t.as_py() or b"").lower())
                while some := list(islice(found, CHUNK)):
                    # a run has the same hash all over its document, so parts of a text add up
                    held.update(run_words(i, Counter([m.group() for m in some]), how))
                    if len(held) >= HELD:
                        yield passed(held)
                        held = Counter()
        if held:
            yield passed(held)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("binary").alias("t"))
    words = (rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
                 .where(F.col("n") >= how.min_count))
    return staged(words.withColumn("id", F.monotonically_increasing_id()), "spelling-words")


def symbols(letters: dict[str, int], size: int) -> dict[str, int]:
    """A symbol 1 to ``size`` for each letter, all about equally frequent."""
    load, out = [0] * size, {}
    for letter, n in sorted(letters.items(), key=lambda x: (-x[1], x[0])):
        s = min(range(size), key=lambda j: load[j])
        load[s] += n
        out[letter] = s + 1
    return out


def alphabet_sizes(lengths: dict[int, int], room: int) -> dict[int, int]:
    """Symbols for words of each length: the least with ``room`` times as
    many reduced words as there are words (capped where the words are long
    enough for two)."""
    out = {}
    for length, n in lengths.items():
        k = 2
        while length * (k - 1).bit_length() < 64 and k ** length < room * n:
            k += 1
        out[length] = k
    return out


class Reduced:
    """Reduced words of a vocabulary and the keys of their neighbourhoods."""

    def __init__(self, letters: dict[str, int], sizes: dict[int, int], longest: int):
        self.sizes, self.longest = sizes, longest
        self.tables = {k: symbols(letters, k) for k in set(sizes.values()) | {2}}

    def size(self, length: int) -> int:
        return self.sizes.get(min(length, self.longest), 2)

    def _codes(self, words: list[str], length: int, size: int):
        import numpy as np

        table = np.zeros(256, np.uint64)
        for letter, s in self.tables[size].items():
            table[ord(letter)] = s
        return table[np.frombuffer("".join(words).encode("latin-1"), np.uint8)].reshape(len(words), length)

    @staticmethod
    def _powers(n: int):
        import numpy as np

        p = np.full(n + 1, BASE, np.uint64)
        p[0] = 1
        return np.cumprod(p, dtype=np.uint64)

    @staticmethod
    def _key(h, length: int):
        """Keys of words of different lengths differ."""
        import numpy as np

        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return ((h & ~np.uint64(63)) | np.uint64(length & 63)).view(np.int64)

    def own(self, words: list[str]):
        """The key of each of some words of one length."""
        import numpy as np

        length = len(words[0])
        x = self._codes(words, length, self.size(length))
        return self._key((x * self._powers(length)[:length]).sum(axis=1, dtype=np.uint64), length)

    def neighbours(self, words: list[str]):
        """(place in ``words``, key, whether it is the own key) of the edges
        generated at words of one length, in blocks of columns."""
        import numpy as np

        length, p = len(words[0]), self._powers(len(words[0]))
        every = np.arange(len(words))
        for target in (length, length - 1):
            size = self.size(target)
            x = self._codes(words, length, size)
            before = np.concatenate([np.zeros((len(words), 1), np.uint64),
                                     np.cumsum(x * p[:length], axis=1, dtype=np.uint64)], axis=1)
            after = np.zeros(len(words), np.uint64)  # the hash of what follows place i
            if target == length:
                yield every, self._key(before[:, length], target), True
            for i in range(length - 1, -1, -1):
                if target == length:
                    for s in range(2, size + 1):
                        at = np.flatnonzero(x[:, i] < s)
                        yield at, self._key(before[at, i] + p[i] * (np.uint64(s) + np.uint64(BASE) * after[at]), target), False
                else:  # of a run of equal symbols, the first goes
                    at = every if i == 0 else np.flatnonzero(x[:, i] != x[:, i - 1])
                    yield at, self._key(before[at, i] + p[i] * after[at], target), False
                after = x[:, i] + np.uint64(BASE) * after

    def once(self, words: list[str]):
        """:meth:`neighbours` as three arrays; a key that a word has twice
        (by a hash shared within its neighbourhood) is there once."""
        import numpy as np

        parts = list(self.neighbours(words))
        at = np.concatenate([a for a, _, _ in parts])
        key = np.concatenate([k for _, k, _ in parts])
        own = np.concatenate([np.full(len(a), o) for a, _, o in parts])
        order = np.lexsort((~own, key, at))  # the own key before another equal one
        at, key, own = at[order], key[order], own[order]
        first = np.ones(len(at), bool)
        first[1:] = (at[1:] != at[:-1]) | (key[1:] != key[:-1])
        return at[first], key[first], own[first]


def near_words(words: DataFrame, how: Variants = Variants()) -> DataFrame:
    """(a, b): ids of every pair of words that differ by one edit, in both
    directions, from (word, n, id)."""
    letters = {r[0]: r[1] for r in words.select(F.explode(F.split("word", "")).alias("c")).where("c <> ''")
               .groupBy("c").count().collect()}  # at most 90 letters
    longest = 64
    lengths = {r[0]: r[1] for r in words.groupBy(F.least(F.length("word"), F.lit(longest))).count().collect()}
    reduced = Reduced(letters, alphabet_sizes(lengths, how.room), longest)

    def batched(make):
        def run(batches):
            import numpy as np

            for b in batches:
                word, ids = b.column(0).to_pylist(), np.asarray(b.column(1))
                size = np.array([len(w) for w in word])
                for length in np.unique(size):
                    at = np.flatnonzero(size == length)
                    step = max(1, (1 << 16) // int(length))
                    for lo in range(0, len(at), step):
                        part = at[lo:lo + step]
                        yield from make([word[i] for i in part], ids[part])
        return run

    def own(some, ids):
        import pyarrow as pa

        yield pa.RecordBatch.from_arrays([pa.array(reduced.own(some)), pa.array(ids), pa.array(some, pa.string())],
                                         names=["key", "b", "wb"])

    def looked(some, ids):
        import pyarrow as pa

        at, key, first = reduced.once(some)
        held = pa.array(some, pa.string())
        for lo in range(0, len(at), 1 << 17):
            i = slice(lo, lo + (1 << 17))
            yield pa.RecordBatch.from_arrays([pa.array(key[i]), pa.array(ids[at[i]]), held.take(pa.array(at[i])),
                                              pa.array(first[i])], names=["key", "a", "wa", "own"])

    source = words.select("word", "id")
    table = source.mapInArrow(batched(own), "key long, b long, wb string")
    asked = source.mapInArrow(batched(looked), "key long, a long, wa string, own boolean")
    met = asked.join(table, "key").where((~F.col("own") | (F.col("a") < F.col("b")))
                                         & (F.levenshtein("wa", "wb", 1) == 1))
    both = F.explode(F.array(F.struct(F.col("a"), F.col("b")), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
    return met.select(both.alias("p")).select("p.a", "p.b")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last form on the way from each word, from (word,
    form) with a form for every word.  The way doubles every round; forms
    are ever more frequent, so it ends."""
    far = staged(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = far.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = staged(far.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                          F.col("next").isNotNull().alias("moved")), "spelling-roots")
        far = step.select("word", "root")
        if step.where("moved").isEmpty():
            return far


def variants(docs: DataFrame, how: Variants = Variants(), text: str = "text") -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``docs``.

    A word's form is its near word of largest n (ties: the smallest) if that n
    is at least ``factor`` times its own, else null; root is the last form on
    the way, the word itself if it has none; n_near counts its near words.

    Null and empty texts have no words; a null id hashes as ``null``; repeated
    rows count each time; an empty table gives no rows; other columns are not
    read.  Words of any length are compared whole."""
    words = vocabulary(docs, how, text)
    pairs = near_words(words, how)
    of = words.select(F.col("id").alias("b"), F.struct((-F.col("n")).alias("less"), "word").alias("best"))
    near = pairs.join(of, "b").groupBy("a").agg(F.count(F.lit(1)).alias("n_near"), F.min("best").alias("best"))
    frequent = -F.col("best.less") >= how.factor * F.col("n")
    told = words.join(near, words.id == near.a, "left").select(
        "word", F.when(frequent, F.col("best.word")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(frequent, -F.col("best.less")).alias("form_n"))
    told = staged(told, "spelling-forms")
    far = roots(told.where("form is not null"))
    return told.join(far, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
