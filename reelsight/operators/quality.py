"""Record validation and quality gates (VAL5, VAL6, VAL8).

Records arrive as JSON text; each is parsed once into a VARIANT and every
field of the contract is checked with column expressions.  The result keeps
all failures of a record (not just the first) in an ``errors`` array.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelsight.sources.schemas import Field

_INTS = ("BIGINT", "INT", "SMALLINT", "TINYINT")


def _is_int(sch: Column) -> Column:
    return sch.isin(*_INTS)


def _is_number(sch: Column) -> Column:
    return _is_int(sch) | sch.isin("DOUBLE", "FLOAT") | sch.startswith("DECIMAL")


def _check(f: Field, val: Column, sch: Column) -> Column:
    """Error text for one field given its VARIANT value and type name."""
    missing = val.isNull() | (sch == "VOID")
    if f.type in ("long", "int"):
        ok = _is_int(sch)
        if f.type == "int":
            n = F.try_variant_get(val, "$", "bigint")
            ok = ok & n.between(-(2 ** 31), 2 ** 31 - 1)
    elif f.type in ("float", "double"):
        ok = _is_number(sch)
    elif f.type == "string":
        ok = sch == "STRING"
    elif f.type == "enum":
        ok = (sch == "STRING") & F.try_variant_get(val, "$", "string").isin(*f.symbols)
    elif f.type == "array<long>":
        items = F.try_variant_get(val, "$", "array<variant>")
        ok = sch.startswith("ARRAY<") & F.forall(items, lambda x: _is_int(F.schema_of_variant(x)))
    else:  # pragma: no cover - contract typo
        raise ValueError(f"unknown type {f.type}")
    null_msg = F.lit(f"{f.name}: missing or null, expected {f.type}")
    bad_msg = F.concat(F.lit(f"{f.name}: expected {f.type}, got "), F.lower(sch))
    if f.nullable:
        return F.when(missing, F.lit(None).cast("string")).when(~ok, bad_msg)
    return F.when(missing, null_msg).when(~ok, bad_msg)


def _label(errs: Column, key: Column | None) -> Column:
    if key is None:
        return errs
    label = F.concat(F.lit("idx="), key.cast("string"), F.lit(": "))
    return F.transform(errs, lambda e: F.concat(label, e))


def stage_fields(df: DataFrame, json_col: str, names: Iterable[str]) -> DataFrame:
    """Parse once and extract each named field (value and type name) into
    its own column.  Each step is a generator of one row: a filter on the
    errors moves below plain projections and would take the parsing of the
    JSON with it, once for every place in the check that names a field; below
    a generator it does not move, so a record is parsed once."""
    names = list(dict.fromkeys(names))
    out = df.select("*", F.explode(F.array(F.try_parse_json(F.col(json_col)))).alias("_v"))
    fields = [F.try_variant_get(F.col("_v"), f"$.{n}", "variant").alias(f"_f_{n}") for n in names]
    out = out.select("*", F.inline(F.array(F.struct(*fields)))) if names else out
    types = [F.schema_of_variant(F.col(f"_f_{n}")).alias(f"_s_{n}") for n in names]
    return out.select("*", F.inline(F.array(F.struct(*types)))) if names else out


def staged_errors(record: tuple[Field, ...], key: Column | None = None) -> Column:
    """Errors of a record from the columns made by :func:`stage_fields`."""
    errs = F.array_compact(F.array(*[_check(f, F.col(f"_f_{f.name}"), F.col(f"_s_{f.name}")) for f in record]))
    return _label(F.when(F.col("_v").isNull(), F.array(F.lit("invalid JSON"))).otherwise(errs), key)


def drop_staged(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c == "_v" or c.startswith("_f_") or c.startswith("_s_")])


def validate_json(df: DataFrame, json_col: str, record: tuple[Field, ...], key: str | None = None) -> DataFrame:
    """Add ``errors`` (array of ``"idx=<key>: field: problem"``) and ``ok``
    (VAL5).  ``key`` labels the record (the reference labels by batch
    position)."""
    staged = stage_fields(df, json_col, [f.name for f in record])
    out = staged.withColumn("errors", staged_errors(record, F.col(key) if key else None))
    return drop_staged(out).withColumn("ok", F.size("errors") == 0)


def validation_summary(validated: DataFrame) -> DataFrame:
    """``(ok, records, invalid, errors)`` over a validated batch (VAL5)."""
    return validated.agg(F.coalesce(F.bool_and("ok"), F.lit(True)).alias("ok"),
                         F.count(F.lit(1)).alias("records"),
                         F.sum(F.when(F.col("ok"), 0).otherwise(1)).alias("invalid"),
                         F.sum(F.size("errors")).alias("errors"))


def assert_valid(validated: DataFrame) -> DataFrame:
    """Fail the job on the first invalid record (VAL6).  The check is a
    filter, so no later projection can prune it, and nothing is collected."""
    bad = F.raise_error(F.concat(F.lit("invalid record: "), F.concat_ws("; ", F.col("errors")))).cast("boolean")
    return validated.where(F.when(F.col("ok"), F.lit(True)).otherwise(bad))


def require_columns(df: DataFrame, required: Iterable[str], what: str = "input") -> DataFrame:
    """Analysis-time column gate (VAL8): raise listing missing columns."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"{what} missing required columns: {missing}")
    return df
