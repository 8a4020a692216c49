"""Byte-level BPE by reduction over a tree: encode halves, join neighbours.

Two levels, both with the same shape.

Text.  A text longer than ``LEAF`` characters is cut in two anywhere, the
halves are split into pattern matches recursively, and joined: the matches of
the left half whose end lies more than ``LOOKAHEAD`` characters before the cut
cannot have looked past it and stay; from there on the pattern runs over the
text again, and the window grows into the right half until a match ends where
a match of the right half ends, too.  A match depends only on the text from
its start, so everything after that point stays.

Match.  A match that is no token itself is cut in two bytewise, the halves
are encoded recursively, and joined: a window of tokens around the cut is
encoded again from bytes, and grows on either side until the pair of tokens at
that side's edge is stable.  A pair (x, y) is stable if encoding the bytes of
x and y together gives x, y again; a sequence in which every neighbouring pair
is stable is the encoding of its bytes (any merge that the greedy order would
do across a border would also be done with only the two tokens present), so
the tokens outside the window are proven right.

Decoding looks up each id's bytes and concatenates up a tree of halves.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters of a leaf of the text tree.
LEAF = 8192
#: No match reads further than this past its end (a contraction's letters,
#: one character after white space).
LOOKAHEAD = 3
#: Bytes of a leaf of the match tree.
LEAF_BYTES = 16
#: Entries of each of the two generations of the match cache, and of the pair
#: cache; all are only short cuts.
CACHE = 200_000
#: The rank of a pair that is no token.
NONE = 1 << 60


def load_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a tiktoken vocabulary file."""
    with open(path, "rb") as f:
        return {base64.b64decode(tok): int(rank) for tok, rank in map(bytes.split, f)}


class Codec:
    """Encoder and decoder for one vocabulary and one split pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks = ranks
        self.bytes = {r: t for t, r in ranks.items()}
        self.pattern = regex.compile(pattern)
        self.cache: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}
        self.pairs: dict[tuple[int, int], bool] = {}

    # -- one match ---------------------------------------------------------

    def _merge(self, raw: bytes) -> list[int]:
        """Greedy merges, lowest rank first, leftmost first: for leaves,
        windows and pairs, which are short."""
        parts = [raw[i:i + 1] for i in range(len(raw))]
        get = self.ranks.get
        pair = [get(raw[i:i + 2], NONE) for i in range(len(raw) - 1)]
        while pair:
            low = min(pair)
            if low == NONE:
                break
            i = pair.index(low)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del pair[i]
            if i:
                pair[i - 1] = get(parts[i - 1] + parts[i], NONE)
            if i < len(pair):
                pair[i] = get(parts[i] + parts[i + 1], NONE)
        return [self.ranks[p] for p in parts]

    def stable(self, x: int, y: int) -> bool:
        got = self.pairs.get((x, y))
        if got is None:
            if len(self.pairs) >= CACHE:
                self.pairs.clear()
            got = self._merge(self.bytes[x] + self.bytes[y]) == [x, y]
            self.pairs[(x, y)] = got
        return got

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two neighbouring byte strings from theirs."""
        if not left or not right:
            return left + right
        if self.stable(left[-1], right[0]):
            return left + right
        i, j = len(left) - 1, 1  # the window is left[i:] + right[:j]
        while True:
            window = self._merge(b"".join(self.bytes[t] for t in left[i:] + right[:j]))
            grow_left = i > 0 and not self.stable(left[i - 1], window[0])
            grow_right = j < len(right) and not self.stable(window[-1], right[j])
            if not grow_left and not grow_right:
                return left[:i] + window + right[j:]
            if grow_left:
                i = max(0, i - 2)
            if grow_right:
                j = min(len(right), j + 2)

    def encode_bytes(self, raw: bytes) -> list[int]:
        """A match's bytes, without the whole-match short cut."""
        if len(raw) <= LEAF_BYTES:
            return self._merge(raw)
        # halves bottom up: neighbours are joined level by level
        level = [self._merge(raw[i:i + LEAF_BYTES]) for i in range(0, len(raw), LEAF_BYTES)]
        while len(level) > 1:
            level = [self.join(level[k], level[k + 1]) if k + 1 < len(level) else level[k]
                     for k in range(0, len(level), 2)]
        return level[0]

    def encode_match(self, piece: str) -> tuple[int, ...]:
        got = self.cache.get(piece)
        if got is None:
            got = self.old.get(piece)
            if got is None:
                raw = piece.encode("utf-8", "surrogatepass")
                whole = self.ranks.get(raw)
                got = (whole,) if whole is not None else tuple(self.encode_bytes(raw))
            if len(piece) <= 64:
                if len(self.cache) >= CACHE:  # what was not met lately goes
                    self.old, self.cache = self.cache, {}
                self.cache[piece] = got
        return got

    # -- a text ------------------------------------------------------------

    def split(self, text: str) -> list[str]:
        """The pattern's matches over the whole text."""
        leaves = [text[i:i + LEAF] for i in range(0, len(text), LEAF)] or [""]
        level = [self.pattern.findall(t) for t in leaves]
        while len(level) > 1:
            level = [self._join_matches(level[k], level[k + 1]) if k + 1 < len(level) else level[k]
                     for k in range(0, len(level), 2)]
        return level[0]

    def _join_matches(self, left: list[str], right: list[str]) -> list[str]:
        back, keep = 0, len(left)
        while keep and back < LOOKAHEAD:  # these may have looked past the cut
            keep -= 1
            back += len(left[keep])
        window, take, at_end = left[keep:], 0, 0
        size = 1
        while True:
            # grow into the right half, then match from the last sure end
            grown = right[take:take + size]
            window_text = "".join(window) + "".join(grown)
            take += len(grown)
            got = self.pattern.findall(window_text)
            if take == len(right):
                return left[:keep] + got
            # a match may only be trusted if it ends well inside the window
            ends, pos = set(), sum(map(len, window))
            for g in grown:
                pos += len(g)
                ends.add(pos)
            pos, sure = 0, []
            for g in got:
                pos += len(g)
                if pos + LOOKAHEAD > len(window_text):
                    break
                sure.append(g)
                if pos in ends:
                    done, at_end = 0, sum(map(len, window))
                    for k, r in enumerate(right[take - len(grown):]):
                        at_end += len(r)
                        done = k + 1
                        if at_end == pos:
                            break
                    return left[:keep] + sure + right[take - len(grown) + done:]
            window = [window_text]
            size *= 2

    def encode(self, text: str) -> list[int]:
        match, out = self.encode_match, []
        for piece in self.split(text):
            got = self.cache.get(piece)
            out += match(piece) if got is None else got
        return out

    def decode(self, ids: list[int]) -> bytes:
        """The bytes of a sequence of ids, joined up a tree of halves."""
        get = self.bytes
        level = [b"".join([get[t] for t in ids[i:i + LEAF]]) for i in range(0, len(ids), LEAF)] or [b""]
        while len(level) > 1:
            level = [b"".join(level[k:k + 2]) for k in range(0, len(level), 2)]
        return level[0]


def codec(spark: SparkSession, path: str, pattern: str):
    """A maker of the codec for tasks; the vocabulary file (under 1 MB) is
    read by the driver and sent along."""
    with open(path, "rb") as f:
        data = spark.sparkContext.broadcast(f.read())

    def make() -> Codec:
        return Codec({base64.b64decode(t): int(r) for t, r in map(bytes.split, data.value.splitlines())}, pattern)

    return make


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """The columns of ``docs`` without ``text``, and ``ids``: array<int> of
    the whole text's tokens (null text: none), ``n_tokens`` and
    ``round_trip``: whether decoding gives the text back.  Special tokens are
    ordinary text.  Columns of ``docs`` called like a new one are replaced.
    Repeated rows stay; an empty table gives no rows."""
    make = codec(docs.sparkSession, path, pattern)
    rest = [f for f in docs.schema.fields if f.name not in (text, ids, "n_tokens", "round_trip")]
    schema = _schema(rest, f"{ids} array<int>", "n_tokens long", "round_trip boolean")

    def run(batches: Iterator):
        import pyarrow as pa

        c = make()
        for b in batches:
            for part in _small(b, text):
                texts = part.column(part.schema.get_field_index(text)).to_pylist()
                got = [c.encode(t or "") for t in texts]
                back = [c.decode(g) == (t or "").encode("utf-8", "surrogatepass") for g, t in zip(got, texts)]
                cols = [part.column(part.schema.get_field_index(f.name)) for f in rest]
                yield pa.RecordBatch.from_arrays(
                    [*cols, pa.array(got, pa.list_(pa.int32())), pa.array([len(g) for g in got], pa.int64()),
                     pa.array(back, pa.bool_())],
                    names=[*(f.name for f in rest), ids, "n_tokens", "round_trip"])

    return docs.select(*[_q(f.name) for f in rest], _q(text)).mapInArrow(run, schema)


def decode(tokens: DataFrame, path: str, pattern: str, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """The columns of ``tokens``, and ``out``: the bytes that ``ids`` stand
    for (null ids: no bytes)."""
    make = codec(tokens.sparkSession, path, pattern)
    cols = [f for f in tokens.schema.fields if f.name != out]
    schema = _schema(cols, f"{out} binary")

    def run(batches: Iterator):
        import pyarrow as pa

        c = make()
        for b in batches:
            got = [c.decode(x or []) for x in b.column(b.schema.get_field_index(ids)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got, pa.binary())],
                                             names=[*b.schema.names, out])

    return tokens.select(*[_q(f.name) for f in cols]).mapInArrow(run, schema)


def digests(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row: both
    directions of the codec in one pass, without moving the ids."""
    make = codec(docs.sparkSession, path, pattern)

    def run(batches: Iterator):
        import pyarrow as pa

        c = make()
        sha = hashlib.sha256
        for b in batches:
            n, enc, dec = [], [], []
            for t in b.column(1).to_pylist():
                got = c.encode(t or "")
                n.append(len(got))
                enc.append(sha(",".join(map(str, got)).encode()).hexdigest())
                dec.append(sha(c.decode(got)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(enc), pa.array(dec)],
                                             names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _q(name: str):
    return F.col("`" + name.replace("`", "``") + "`")


def _schema(fields, *extra: str):
    from pyspark.sql import types as T

    new = [T.StructField(name, T._parse_datatype_string(kind)) for name, kind in map(str.split, extra)]
    return T.StructType([*fields, *new])


def _small(batch, text: str, most: int = 1 << 23) -> Iterator:
    """The batch in slices of few characters, since token lists are larger
    than their texts."""
    import pyarrow.compute as pc

    lens = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0).to_pylist()
    lo, size = 0, 0
    for i, n in enumerate(lens):
        if size and size + n > most:
            yield batch.slice(lo, i - lo)
            lo, size = i, 0
        size += n
    if lo < len(lens) or not lens:
        yield batch.slice(lo)
