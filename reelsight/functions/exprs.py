"""Scalar column expressions shared by the operators.

All helpers return ``pyspark.sql.Column`` objects built from Spark SQL
built-ins, so they stay inside whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(col: ColumnOrName) -> Column:
    return F.col(col) if isinstance(col, str) else col


# ---------------------------------------------------------------- numbers --

def clip(col: ColumnOrName, lo: float, hi: float) -> Column:
    """``min(max(x, lo), hi)``; nulls stay null."""
    return F.least(F.greatest(_c(col), F.lit(lo)), F.lit(hi))


def to_double_or(col: ColumnOrName, default: float = 0.0) -> Column:
    """Numeric coercion: unparsable or missing -> ``default``."""
    return F.coalesce(_c(col).try_cast("double"), F.lit(float(default)))


# ------------------------------------------------------------------ time --

def coerce_ts(col: ColumnOrName, numeric: bool | None = None) -> Column:
    """Timestamp -> epoch seconds (double).

    Numbers pass through as seconds; strings are parsed as ISO-8601 in UTC;
    anything unparsable becomes null.  ``numeric`` tells which branch a
    column of unknown type takes (the caller knows the schema).
    """
    c = _c(col)
    if numeric:
        return c.cast("double")
    parsed = F.try_to_timestamp(F.regexp_replace(c.cast("string"), "Z$", ""))
    return (F.unix_micros(parsed) / F.lit(1_000_000.0))


def event_day(col: ColumnOrName, kind: str) -> Column:
    """Calendar day (UTC) of an epoch-milliseconds number or an ISO string.

    ``kind`` is ``"millis"`` or ``"iso"``; a trailing ``Z`` is ignored and
    unparsable input yields null.
    """
    c = _c(col)
    if kind == "millis":
        return F.to_date(F.timestamp_millis(c.cast("bigint")))
    return F.to_date(F.try_to_timestamp(F.regexp_replace(c.cast("string"), "Z", "")))


def floor_minute(col: ColumnOrName) -> Column:
    """Epoch seconds floored to the minute."""
    c = _c(col)
    return c - F.pmod(c, F.lit(60))


# ----------------------------------------------------------------- lists --

def items_text(col: ColumnOrName, sep: str = ",") -> Column:
    """A list of ids rendered as plain text, ``1,2,3``."""
    return F.array_join(F.transform(_c(col), lambda x: x.cast("string")), sep)


def parse_movie_ids(col: ColumnOrName) -> Column:
    """Parse a list of item ids from its many textual encodings.

    * JSON array -> its elements;
    * JSON object with ``movie_ids`` -> that value, parsed as here;
    * JSON string -> a one-element list;
    * any other valid JSON (bare number, object without the key) -> [];
    * invalid JSON -> outer ``[]`` stripped, split on ``, ; |`` or space;
    * null / blank -> [].

    Elements that are not integers are dropped (the reference raises);
    JSON numbers with a fraction are truncated like Python ``int()``.
    """
    s = F.regexp_replace(_c(col).cast("string"), r"^\s+|\s+$", "")
    v = F.try_parse_json(s)
    key = F.try_variant_get(v, "$.movie_ids", "variant")
    is_obj = F.schema_of_variant(v).startswith("OBJECT<")
    target = F.when(is_obj & key.isNotNull(), key).otherwise(v)
    t_schema = F.schema_of_variant(target)
    elems = F.when(t_schema.startswith("ARRAY<"),
                   F.try_variant_get(target, "$", "array<variant>")) \
             .when(t_schema == "STRING", F.array(target)) \
             .otherwise(F.array().cast("array<variant>"))

    def _elem_to_long(x: Column) -> Column:
        sch = F.schema_of_variant(x)
        as_text = F.try_variant_get(x, "$", "string")
        return (F.when(sch == "STRING", F.regexp_replace(as_text, r"^\s+|\s+$", "").try_cast("bigint"))
                 .when(sch.startswith("DECIMAL") | (sch == "DOUBLE") | (sch == "BIGINT")
                       | (sch == "INT") | (sch == "FLOAT"),
                       F.try_variant_get(x, "$", "double").try_cast("bigint")))

    json_ids = F.filter(F.transform(elems, _elem_to_long), lambda x: x.isNotNull())

    bracketless = F.when(s.startswith("[") & s.endswith("]"),
                         s.substr(F.lit(2), F.length(s) - 2)).otherwise(s)
    parts = F.filter(F.split(bracketless, r"[,;| ]"), lambda x: x != "")
    text_ids = F.filter(F.transform(parts, lambda x: x.try_cast("bigint")), lambda x: x.isNotNull())

    empty = F.array().cast("array<bigint>")
    return (F.when(s.isNull() | (s == ""), empty)
             .when(v.isNull(), text_ids)
             .otherwise(json_ids))


# ----------------------------------------------------------- statistics --

# Abramowitz & Stegun 7.1.26 rational approximation of erf
# (|error| < 1.5e-7).  The oracle SQL writes the same polynomial.
ERF_P = 0.3275911
ERF_A = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)


def erf(col: ColumnOrName) -> Column:
    x = _c(col)
    ax = F.abs(x)
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(ERF_P) * ax)
    a1, a2, a3, a4, a5 = ERF_A
    poly = t * (F.lit(a1) + t * (F.lit(a2) + t * (F.lit(a3) + t * (F.lit(a4) + t * F.lit(a5)))))
    y = F.lit(1.0) - poly * F.exp(-ax * ax)
    return F.when(x < 0, -y).otherwise(y)


def normal_cdf(col: ColumnOrName) -> Column:
    return F.lit(0.5) * (F.lit(1.0) + erf(_c(col) / F.lit(math.sqrt(2.0))))


def erf_sql(x: str) -> str:
    """The same approximation as SQL text (for DuckDB oracles)."""
    a1, a2, a3, a4, a5 = ERF_A
    t = f"(1.0 / (1.0 + {ERF_P} * abs({x})))"
    poly = f"({t} * ({a1} + {t} * ({a2} + {t} * ({a3} + {t} * ({a4} + {t} * {a5})))))"
    y = f"(1.0 - {poly} * exp(-abs({x}) * abs({x})))"
    return f"(CASE WHEN ({x}) < 0 THEN -{y} ELSE {y} END)"


def normal_cdf_sql(x: str) -> str:
    return f"(0.5 * (1.0 + {erf_sql(f'(({x}) / {math.sqrt(2.0)!r})')}))"


def hash_uniform(seed: int | str, *keys: ColumnOrName) -> Column:
    """Deterministic U[0,1) from ``md5(seed || '|' || key...)``.

    Same value in every engine that has md5: the first 8 hex digits read
    as an unsigned 32-bit integer, divided by 2^32.
    """
    parts = [F.lit(str(seed))]
    for k in keys:
        parts += [F.lit("|"), _c(k).cast("string")]
    h = F.md5(F.concat(*parts))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def hash_uniform_sql(seed: int | str, *keys: str) -> str:
    inner = f"'{seed}'" + "".join(f" || '|' || CAST({k} AS VARCHAR)" for k in keys)
    return f"(CAST(('0x' || substr(md5({inner}), 1, 8)) AS BIGINT) / 4294967296.0)"


def ideal_dcg(n: ColumnOrName) -> Column:
    """``sum_{i=1..n} 1/log2(i+1)``; 0 for n <= 0."""
    c = _c(n)
    return F.when(c <= 0, F.lit(0.0)).otherwise(
        F.aggregate(F.sequence(F.lit(1), c.cast("int")), F.lit(0.0),
                    lambda acc, i: acc + F.lit(1.0) / F.log2(i + F.lit(1))))
