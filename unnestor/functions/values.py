"""Scalar value operators (V1-V9), all built-in column expressions.

Every function returns a ``Column`` (or works on metadata strings) so the work
stays inside whole-stage codegen; nothing here is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


# -- V1 ----------------------------------------------------------------------
def stringify(x: ColumnOrName) -> Column:
    """Text of a JSON value that was parsed into a text column: strings as
    they are, everything else its JSON text; null or missing become ``''``."""
    return F.coalesce(_c(x), F.lit(""))


# -- V2 ----------------------------------------------------------------------
def _or_fail(raw: Column, value: Column, what: str) -> Column:
    """``value``, failing the job where ``raw`` is present but did not
    convert (independent of the session's ANSI setting)."""
    msg = F.concat(F.lit(f"not a {what}: "), raw)
    return F.when(raw.isNotNull() & value.isNull(), F.raise_error(msg)).otherwise(value)


def as_float(x: ColumnOrName, strict: bool = True) -> Column:
    """Declared float: JSON numbers and numeric strings become 32-bit floats.
    Strict mode fails the job on text that is not a number; permissive mode
    gives null (and the caller routes the row to quarantine)."""
    x = _c(x).cast("string")
    value = x.try_cast(T.FloatType())
    return _or_fail(x, value, "float") if strict else value


# -- V3 ----------------------------------------------------------------------
def as_timestamp(x: ColumnOrName, strict: bool = True) -> Column:
    x = _c(x).cast("string")
    value = F.try_to_timestamp(x)
    return _or_fail(x, value, "timestamp") if strict else value


# -- V4 ----------------------------------------------------------------------
def typed(x: ColumnOrName, data_type: T.DataType) -> Column:
    """Cast that never fails: text that does not fit the type becomes null.
    (``'12.7'`` to integer is null, not 12.)"""
    x = _c(x)
    if isinstance(data_type, T.StringType):
        return x.cast(T.StringType())
    return x.try_cast(data_type)


# -- V5 ----------------------------------------------------------------------
def key_of(*parts: ColumnOrName) -> Column:
    """Generated key: concatenation with null propagation (a null part gives a
    null key, which the sink sets aside)."""
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


# -- V6 ----------------------------------------------------------------------
# The control characters removed from text before loading
# (NUL and vertical tab).
CONTROL_CHARS = "\x00\x0b"


def strip_control(x: ColumnOrName) -> Column:
    """Only texts that hold one are taken apart (``translate`` goes through a
    text sign by sign, which costs more than writing it)."""
    x = _c(x)
    nul, tab = (F.contains(x, F.lit(sign)) for sign in CONTROL_CHARS)
    return F.when(nul | tab, F.translate(x, CONTROL_CHARS, "")).otherwise(x)


# -- V7 ----------------------------------------------------------------------
def json_text(x: ColumnOrName) -> Column:
    return F.to_json(_c(x))


# -- V8 ----------------------------------------------------------------------
def sanitize_name(name: str) -> str:
    """Table name as written to the store: ``-`` -> ``_``, lower case."""
    return name.replace("-", "_").lower()


def sanitize_name_col(x: ColumnOrName) -> Column:
    return F.lower(F.translate(_c(x), "-", "_"))


# -- V9 ----------------------------------------------------------------------
def null_policy_exprs(schema: T.StructType, json_structs: bool = True) -> list[Column]:
    """Sink null policy, one expression per column:

    map -> JSON text, null -> ``{}``; array -> JSON text, null -> ``[]``;
    string: ``''`` -> null, control characters removed; boolean null -> false;
    long null -> 0; struct -> JSON text (so every store can hold it);
    int, float, double, timestamp unchanged.
    """
    out = []
    for f in schema.fields:
        c, t = F.col(f"`{f.name}`"), f.dataType
        if isinstance(t, T.MapType):
            e = F.coalesce(F.to_json(c), F.lit("{}"))
        elif isinstance(t, T.ArrayType):
            e = F.coalesce(F.to_json(c), F.lit("[]"))
        elif isinstance(t, T.StructType) and json_structs:
            e = F.to_json(c)
        elif isinstance(t, T.StringType):
            e = strip_control(F.nullif(c, F.lit("")))
        elif isinstance(t, T.BooleanType):
            e = F.coalesce(c, F.lit(False))
        elif isinstance(t, T.LongType):
            e = F.coalesce(c, F.lit(0).cast(T.LongType()))
        else:
            e = c
        out.append(e.alias(f.name))
    return out


def apply_null_policy(df: DataFrame, json_structs: bool = True) -> DataFrame:
    """V9 as a single projection (not one ``withColumn`` per column)."""
    return df.select(*null_policy_exprs(df.schema, json_structs))


def fill_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Opt-in: replace nulls of the named columns by declared defaults."""
    return df.select(
        *[
            (F.coalesce(F.col(f"`{c}`"), F.lit(defaults[c]).cast(df.schema[c].dataType)).alias(c)
             if c in defaults else F.col(f"`{c}`"))
            for c in df.columns
        ]
    )
