"""Fill-in-the-middle transformation by a piece table.

A document is a list of descriptors (buffer, start, length) over two
immutable buffers: the text as it came and the sentinels.  Cutting splits a
descriptor in two, an arrangement permutes the descriptors and puts sentinel
descriptors between them; neither copies text.  Restoring lays a new table over
the arranged bytes, cuts it at the sentinels, drops their descriptors and
applies the inverse permutation.  Digests are fed one descriptor after the
other.

Forms: ``psm`` (prefix, suffix, middle), ``spm`` (suffix, prefix, middle) and
``plain`` (the text itself).  A text that is empty or holds a sentinel stays
plain, so the sentinels of an arranged text are always its own: a sentinel
starts with ``<`` and has no other, so none can arise across a cut.

Cuts and forms come from a hash of the document's id, so reruns agree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TEXT, MARKS = 0, 1


@dataclass(frozen=True)
class Piece:
    """``length`` bytes from ``start`` of a buffer."""
    buffer: int
    start: int
    length: int


@dataclass(frozen=True)
class Infill:
    """Of 100 documents ``plain_from`` to 99 stay plain; of the others
    ``spm_percent`` in 100 have their suffix first."""
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    seed: str = "1"
    plain_from: int = 90
    spm_percent: int = 20

    @property
    def marks(self) -> tuple[bytes, ...]:
        return tuple(m.encode() for m in (self.prefix, self.suffix, self.middle))

    def order(self, form: str) -> tuple[int, ...]:
        """Which part (0 prefix, 1 middle, 2 suffix) stands in each place."""
        return (2, 0, 1) if form == "spm" else (0, 2, 1)


#: The sentinel in front of the prefix, the middle and the suffix.
MARK_OF = (0, 2, 1)


def cut(pieces: list[Piece], at: int) -> list[Piece]:
    """The same content with a descriptor border at byte ``at``."""
    out, seen = [], 0
    for p in pieces:
        if seen < at < seen + p.length:
            out += [Piece(p.buffer, p.start, at - seen), Piece(p.buffer, p.start + at - seen, seen + p.length - at)]
        else:
            out.append(p)
        seen += p.length
    return out


def span(pieces: list[Piece], lo: int, hi: int) -> list[Piece]:
    """The descriptors of bytes ``lo`` to ``hi``; both are borders."""
    out, seen = [], 0
    for p in pieces:
        if p.length and lo <= seen and seen + p.length <= hi:
            out.append(p)
        seen += p.length
    return out


def stream(pieces: list[Piece], buffers: tuple[bytes, bytes]) -> Iterator[memoryview]:
    views = [memoryview(b) for b in buffers]
    for p in pieces:
        yield views[p.buffer][p.start:p.start + p.length]


def digest(pieces: list[Piece], buffers: tuple[bytes, bytes]) -> str:
    h = hashlib.sha256()
    for part in stream(pieces, buffers):
        h.update(part)
    return h.hexdigest()


def arrange(text: bytes, lo: int, hi: int, form: str, how: Infill = Infill()) -> tuple[list[Piece], tuple[bytes, bytes]]:
    """The descriptors of the arranged text, and the buffers they point to;
    the prefix ends at byte ``lo``, the middle at byte ``hi``."""
    buffers = (text, b"".join(how.marks))
    whole = [Piece(TEXT, 0, len(text))]
    if form == "plain":
        return whole, buffers
    whole = cut(cut(whole, lo), hi)
    parts = [span(whole, 0, lo), span(whole, lo, hi), span(whole, hi, len(text))]
    starts = [0, len(how.marks[0]), len(how.marks[0]) + len(how.marks[1])]
    out: list[Piece] = []
    for part in how.order(form):
        mark = MARK_OF[part]
        out += [Piece(MARKS, starts[mark], len(how.marks[mark])), *parts[part]]
    return out, buffers


def unarrange(arranged: bytes, form: str, how: Infill = Infill()) -> list[Piece]:
    """Descriptors over ``arranged`` that read as the text it was made of."""
    whole = [Piece(TEXT, 0, len(arranged))]
    if form == "plain":
        return whole
    order, at, ends = how.order(form), 0, []
    for part in order:  # the sentinels stand in this order, each once
        at = arranged.index(how.marks[MARK_OF[part]], at)
        ends.append((at, at + len(how.marks[MARK_OF[part]])))
        at = ends[-1][1]
    for lo, hi in ends:
        whole = cut(cut(whole, lo), hi)
    stops = [lo for lo, _ in ends[1:]] + [len(arranged)]
    parts: list[list[Piece]] = [[], [], []]
    for place, part in enumerate(order):  # the inverse permutation
        parts[part] = span(whole, ends[place][1], stops[place])
    return [p for part in parts for p in part]


def choice(doc_id: int | None, text: bytes, how: Infill = Infill()) -> tuple[int, int, int, str]:
    """Code points of the text, where prefix and middle end, and the form; a
    null id is hashed as ``null``."""
    import numpy as np

    key = hashlib.sha256(f"{how.seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(key[i:i + 8], 16) for i in (0, 8, 16, 24))
    n = len(text) if text.isascii() else int(np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in how.marks) or h3 % 100 >= how.plain_from:
        return n, a, b, "plain"
    return n, a, b, "spm" if h4 % 100 < how.spm_percent else "psm"


def byte_at(text: bytes, n: int, *points: int) -> list[int]:
    """Byte offsets of code point offsets of a text of ``n`` code points."""
    import numpy as np

    if n == len(text):
        return list(points)
    starts = np.append(np.flatnonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80), len(text))
    return [int(starts[p]) for p in points]


def transform(docs: DataFrame, how: Infill = Infill(), text: str = "text", keep: list[Column] | None = None) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars (null if plain), output and
    the columns of ``keep`` for every row.

    Null texts are empty and stay plain; null ids are hashed as ``null``;
    repeated rows stay; an empty table gives no rows; other columns are not
    read."""
    def run(batches):
        import pyarrow as pa

        for b in batches:
            rows = []
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                raw = t.as_py() or b""
                n, lo, hi, form = choice(i, raw, how)
                pieces, buffers = arrange(raw, *byte_at(raw, n, lo, hi), form, how)
                plain = form == "plain"
                rows.append((n, form, None if plain else lo, None if plain else hi - lo,
                             b"".join(stream(pieces, buffers)).decode()))
            cols = list(zip(*rows)) if rows else [()] * 5
            new = [pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([b.column(0), *new, *b.columns[2:]],
                                             names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output",
                                                    *b.schema.names[2:]])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("binary").alias("_t"), *(keep or []))
    more = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[2:])
    return rows.mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string" + more)


def restore(arranged: DataFrame, how: Infill = Infill()) -> DataFrame:
    """The rows of :func:`transform` with ``restored``, the text rebuilt from
    output and form alone."""
    def run(batches):
        import pyarrow as pa

        for b in batches:
            got = [b"".join(stream(unarrange(o.encode(), f, how), (o.encode(), b""))).decode()
                   for o, f in zip(b.column("output").to_pylist(), b.column("form").to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got, pa.string())], names=[*b.schema.names, "restored"])

    more = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in arranged.schema.fields)
    return arranged.mapInArrow(run, more + ", restored string")


def digests(docs: DataFrame, how: Infill = Infill(), text: str = "text") -> DataFrame:
    """The rows of :func:`transform` with SHA-256 digests of output and
    restored text instead of the texts: both are streamed from descriptors, and
    no arranged text leaves its task."""
    def run(batches):
        import pyarrow as pa

        for b in batches:
            rows = []
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                raw = t.as_py() or b""
                n, lo, hi, form = choice(i, raw, how)
                pieces, buffers = arrange(raw, *byte_at(raw, n, lo, hi), form, how)
                output = b"".join(stream(pieces, buffers))
                plain = form == "plain"
                rows.append((n, form, None if plain else lo, None if plain else hi - lo, digest(pieces, buffers),
                             digest(unarrange(output, form, how), (output, b""))))
            cols = list(zip(*rows)) if rows else [()] * 6
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, k) for c, k in zip(cols, kinds)]],
                                             names=["doc_id", "n", "form", "prefix_chars", "middle_chars",
                                                    "output_sha256", "restored_sha256"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("binary").alias("_t"))
    return rows.mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, "
                                "output_sha256 string, restored_sha256 string")
