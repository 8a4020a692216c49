"""Quality rules: base counts of a text, and cross-document line frequency.

Lines are normalised and hashed: lower case and single spaces, so lines that
differ in a figure or sign are different lines.  Lines whose normal form is
empty are never removed.  For each host the distinct documents that hold a line
are counted.  A line is removed from the documents of a host if
more than ``max_docs`` documents of that host hold it and it is not merely
part of copies of one text: no single text family (documents with the same
set of lines) makes up ``max_family`` of its documents.  For one line this is
the same as comparing its documents' other lines, so a line that dominates its
documents is no family by itself.  A document is depleted, and rejected, if
less than ``min_left`` of the characters of its normalised lines remain.

Many near copies of a text with an edit each deplete one another.  So that one
is left for the near-duplicate stage, a depleted document stays whole if it is
the first (by id, then hash of the text) of the near copies that hold some
removed line.  A depleted
document counts as a near copy if beside its longest removed line, too, at
least ``min_copied`` of it is removed; documents that one line depletes are not.

Only DataFrame functions are used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelsight.llm.tables import SPACE, counted_anew, packed, row_key, staged, unpacked, words

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rules:
    min_words: int = 50
    max_repeat_percent: int = 50
    max_docs: int = 20
    max_family: float = 0.5
    min_left: float = 0.3
    min_copied: float = 0.5


def normal(line: Column) -> Column:
    """A line as it is compared across documents: case and white space
    apart, every character counts."""
    return F.trim(F.regexp_replace(F.lower(line), "[\\t-\\r\\p{Z}]+", " "))


def line_hash(norm: Column) -> Column:
    """60 bits of a normalised line's MD5."""
    return F.conv(F.substring(F.md5(norm), 1, 15), 16, 10).cast("long")


def _repeated(ws: Column) -> Column:
    """Words in 3-word windows that occur twice or more in the text.

    The hashes of all windows are sorted with their place; equal neighbours
    mark repeated windows, whose places, in order, cover min(3, distance to
    the next one) words each.  n log n in the text's words, also for very
    long texts."""
    at = F.sequence(F.lit(0), F.size(ws) - 3)
    hashed = F.transform(at, lambda i: F.struct(
        F.xxhash64(F.get(ws, i), F.get(ws, i + 1), F.get(ws, i + 2)).alias("h"), i.alias("i")))
    return F.when(F.size(ws) < 3, F.array().cast("array<struct<h:bigint,i:int>>")).otherwise(F.sort_array(hashed))


def base(docs: DataFrame, rules: Rules = Rules(), host: str = "source", text: str = "text") -> DataFrame:
    """doc_id, _host, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, the row's key (ka, kb) and hash of the text
    (_th), and _lines: the hashes of the normalised lines with their
    characters, each."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    key = row_key(F.col("doc_id"), F.col(host), F.col(text))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(host).cast("string").alias("_host"),
                    key.alias("_k"), t.alias("_t"))
    d = d.select("doc_id", "_host", F.col("_k.a").alias("ka"), F.col("_k.b").alias("kb"), line_hash(F.col("_t")).alias("_th"), "_t", words(F.col("_t")).alias("_w"),
                 F.filter(F.split("_t", "\n"), lambda x: x.rlike(f"[^{SPACE}]")).alias("_l"))
    d = d.select("doc_id", "_host", "ka", "kb", "_th", F.size("_w").cast("long").alias("n_words"),
                 F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
                 sum((F.octet_length("_t") - F.octet_length(F.replace("_t", F.lit(c), F.lit(""))) for c in SYMBOLS),
                     F.lit(0)).cast("long").alias("n_symbols"),
                 (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
                 _repeated(F.col("_w")).alias("_s"),
                 F.transform(F.transform("_l", normal), lambda x: F.struct(
                     line_hash(x).alias("h"), F.length(x).cast("long").alias("w"))).alias("_lines"))
    s = F.col("_s")

    def twice(x: Column, i: Column) -> Column:
        return (F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False))
                | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)))

    d = d.withColumn("_at", F.sort_array(F.transform(F.filter(s, twice), lambda x: x["i"]))).drop("_s")
    at = F.col("_at")
    covered = F.aggregate(
        F.transform(at, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - x, F.lit(3)))),
        F.lit(0), lambda a, x: a + x)
    d = d.withColumn("n_repeat_words", covered.cast("long")).drop("_at")
    failed = ((F.col("n_words") < rules.min_words)
              | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")))
    return d.withColumn("base_failed", failed)


def common_lines(counted: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """(_host, h): the lines to remove, from the result of :func:`base`.

    Repeated rows count as one document.  The copies of a line are counted by
    (host, line, family), then summed by (host, line); both counts are
    combined before the shuffle."""
    one = counted.select("ka", "kb", "_host", F.filter("_lines", lambda x: x["w"] > 0).alias("_lines")).dropDuplicates(["ka", "kb"])
    hashes = F.array_sort(F.array_distinct(F.transform("_lines", lambda x: x["h"])))
    lines = one.select("_host", F.xxhash64(hashes).alias("_family"), F.explode(hashes).alias("h"))
    families = lines.groupBy("_host", "h", "_family").agg(F.count(F.lit(1)).alias("n"))
    totals = families.groupBy("_host", "h").agg(F.sum("n").alias("n_docs"), F.max("n").alias("most"))
    return totals.where((F.col("n_docs") > rules.max_docs)
                        & (F.col("most") < rules.max_family * F.col("n_docs"))).select("_host", "h")


def _judged(docs: DataFrame, rules: Rules, host: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Base counts of every row, and (ka, kb, n_cut, cut) of the rows that
    lose lines."""
    counted = staged(base(docs, rules, host, text), "quality-base")
    common = staged(common_lines(counted, rules), "quality-lines")
    one = ["ka", "kb", "doc_id", "_th", "_host", "base_failed"]
    held = counted.select(*one, _whole().alias("whole"), F.explode("_lines").alias("x")).select(*one, "whole", "x.h", "x.w")
    c = common.select(F.col("_host").alias("_ch"), F.col("h").alias("_h"))
    hit = held.join(c, (F.col("h") == F.col("_h")) & F.col("_host").eqNullSafe(F.col("_ch")), "left_semi")
    cut = hit.groupBy(*one, "whole").agg(
        F.sum("w").alias("_n"), F.max("w").alias("longest"), F.collect_set("h").alias("cut"))
    # a repeated row has met its lines as often as it occurs
    times = counted.groupBy("ka", "kb").agg(F.count(F.lit(1)).alias("times"))
    cut = cut.join(times, ["ka", "kb"]).withColumn("n_cut", (F.col("_n") / F.col("times")).cast("long"))
    cut = staged(cut.drop("_n", "times"), "quality-cut")
    # near copies that deplete one another: the first with each line loses nothing
    n_cut, longest, whole = F.col("n_cut"), F.col("longest"), F.col("whole")
    copies = cut.where(~F.col("base_failed") & (whole - n_cut < rules.min_left * whole) & (n_cut > longest)
                       & (n_cut - longest >= rules.min_copied * (whole - longest)))
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_th", "ka", "kb").alias("k")
    first = copies.select("_host", place, F.explode("cut").alias("h")).groupBy("_host", "h").agg(F.min("k").alias("k"))
    first = first.select(F.col("k.ka").alias("_a"), F.col("k.kb").alias("_b")).distinct()
    cut = cut.join(first, (F.col("ka") == F.col("_a")) & (F.col("kb") == F.col("_b")), "left_anti")
    return counted, cut.select("ka", "kb", "n_cut", "cut")


def _whole() -> Column:
    """Characters of a document's normalised lines."""
    return F.aggregate("_lines", F.lit(0).cast("long"), lambda a, x: a + x["w"])


def _left(rules: Rules) -> Column:
    """Whether enough of a document remains."""
    whole = _whole()
    return whole - F.coalesce(F.col("n_cut"), F.lit(0)) >= rules.min_left * whole


def judge(docs: DataFrame, rules: Rules = Rules(), host: str = "source", text: str = "text") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, n_cut_chars (characters in removed lines) and kept of every row.

    A null text has no words and fails; a null host is a host of its own;
    rows with null ids and repeated rows are judged like any other (repeated
    ones count as one document); an empty table gives no rows."""
    counted, cut = _judged(docs, rules, host, text)
    c = cut.select(F.col("ka").alias("_a"), F.col("kb").alias("_b"), "n_cut")
    j = counted.join(c, (F.col("ka") == F.col("_a")) & (F.col("kb") == F.col("_b")), "left")
    n_cut = F.coalesce(F.col("n_cut"), F.lit(0))
    return j.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                    n_cut.alias("n_cut_chars"), (~F.col("base_failed") & _left(rules)).alias("kept"))


def clean(docs: DataFrame, rules: Rules = Rules(), host: str = "source", text: str = "text",
          length: str = "n_chars") -> DataFrame:
    """``docs`` without the rejected rows, and their texts without the
    removed lines (``length``, if there is such a column, counted anew).
    Other columns, rows that lose nothing and repeated rows stay as they are."""
    counted, cut = _judged(docs, rules, host, text)
    c = cut.select(F.col("ka").alias("_a"), F.col("kb").alias("_b"), "n_cut", "cut")
    j = counted.join(c, (F.col("ka") == F.col("_a")) & (F.col("kb") == F.col("_b")), "left")
    stay = j.where(~F.col("base_failed") & _left(rules)).select("ka", "kb", "cut").dropDuplicates(["ka", "kb"])
    kept = packed(docs, row_key(F.col("doc_id"), F.col(host), F.col(text))).join(stay, ["ka", "kb"])
    was = F.col("row")[text]
    rest = F.array_join(F.filter(F.split(was, "\n"), lambda x: ~(
        x.rlike(f"[^{SPACE}]") & F.array_contains("cut", line_hash(normal(x))))), "\n")
    now = F.when(F.col("cut").isNull(), was).otherwise(rest)
    return unpacked(kept, docs, {text: now} | counted_anew(docs, text, length, now, F.col("cut").isNotNull()))
