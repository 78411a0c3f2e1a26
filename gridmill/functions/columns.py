"""Column and projection functions: renames, narrowing, numeric and text forms."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from gridmill.schemas import weather_parameter

_INTS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATS = (T.FloatType, T.DoubleType)
_RANGE = {"byte": (-2**7, 2**7 - 1), "short": (-2**15, 2**15 - 1), "int": (-2**31, 2**31 - 1)}


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def quoted(name: str) -> Column:
    """Column by literal name, dots and dashes included."""
    return F.col("`" + name.replace("`", "``") + "`")


# -- projections -----------------------------------------------------------------

def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def drop_for_parameter(df: DataFrame, parameter: str) -> DataFrame:
    """Drop the technical columns of a weather parameter; missing ones are ignored."""
    return df.drop(*weather_parameter(parameter)[1])


def select_fields(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    return df.select(*[quoted(f) for f in fields])


def header_name(header: str | Iterable[str]) -> str:
    """One flat name from a header or a tuple of header levels."""
    levels = [header] if isinstance(header, str) else [level for level in header if level]
    return "_".join(levels).lower().replace(" ", "_").replace("/", "_")


def normalize_headers(df: DataFrame, headers: Sequence[str | Iterable[str]] | None = None) -> DataFrame:
    return df.toDF(*[header_name(h) for h in (headers if headers is not None else df.columns)])


def narrow(df: DataFrame, ints: str = "short", floats: str = "float") -> DataFrame:
    """Narrow every whole and floating column; values out of range become null."""
    out = []
    for f in df.schema.fields:
        c = quoted(f.name)
        if isinstance(f.dataType, _INTS) and ints in _RANGE:
            # Tested instead of tried: a failed cast costs an exception per row.
            c = F.when(c.between(*_RANGE[ints]), c).cast(ints).alias(f.name)
        elif isinstance(f.dataType, _INTS):
            c = c.cast(ints).alias(f.name)
        elif isinstance(f.dataType, _FLOATS):
            c = c.cast(floats).alias(f.name)
        out.append(c)
    return df.select(*out)


def kelvin_to_celsius(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Subtract in single precision, after the columns were narrowed."""
    zero = F.lit(273.15).cast("float")
    return df.withColumns({c: quoted(c).cast("float") - zero for c in cols})


def warehouse_type(dtype: T.DataType) -> str:
    if isinstance(dtype, _INTS):
        return "bigint"
    if isinstance(dtype, _FLOATS):
        return "double"
    if isinstance(dtype, T.BooleanType):
        return "boolean"
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return "timestamp"
    return "string"


def warehouse_cast(df: DataFrame, partition_col: str) -> DataFrame:
    """Types of the warehouse table: UTC date partition, wide numbers, text for the rest."""
    out = []
    for f in df.schema.fields:
        target = "date" if f.name == partition_col else warehouse_type(f.dataType)
        out.append(quoted(f.name).cast(target).alias(f.name))
    return df.select(*out)


# -- predicates --------------------------------------------------------------------

def all_of(*predicates: Column) -> Column:
    return reduce(lambda a, b: a & b, predicates, F.lit(True))


def after_mark(col: Column | str, mark) -> Column:
    """Strictly newer than the mark; no mark keeps everything."""
    return F.lit(True) if mark is None else _c(col) > F.lit(mark)


def drop_any_null(df: DataFrame) -> DataFrame:
    return df.na.drop("any")


def drop_null_dates(df: DataFrame, col: str) -> DataFrame:
    """Parse a date column where it is text, drop rows without a date."""
    if isinstance(df.schema[col].dataType, T.StringType):
        df = df.withColumn(col, F.try_to_timestamp(quoted(col)))
    return df.na.drop(subset=[col])


# -- numbers -----------------------------------------------------------------------

def coerce_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Text to number; text that is none, and NaN, become null."""
    def number(c: Column) -> Column:
        value = c.try_cast("double")
        return F.when(~F.isnan(value), value)

    return df.withColumns({c: number(quoted(c)) for c in cols})


def row_mean(cols: Sequence[Column | str]) -> Column:
    """Mean across columns, nulls left out; null if all are."""
    cs = [_c(c) for c in cols]
    total = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0.0)) for c in cs])
    present = reduce(lambda a, b: a + b, [c.isNotNull().cast("int") for c in cs])
    return F.try_divide(total, present)


# -- text --------------------------------------------------------------------------

def series_title(col: Column | str) -> Column:
    """``a_run-of_2b`` to ``A Run-Of 2B``: every letter after a non-letter is a capital."""
    # Runs of letters and single other characters, in order.
    parts = F.regexp_extract_all(F.translate(_c(col), "_", " "), F.lit(r"(\p{L}+|[^\p{L}])"), 1)
    return F.array_join(F.transform(parts, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 1_000_000)))), "")


def fixed2(col: Column | str, suffix: str = "") -> Column:
    """Two decimals and a suffix; blank for null."""
    c = _c(col)
    # format_number rounds the binary value half-even; printf-style formatting does not.
    text = F.concat(F.call_function("format_number", c.cast("double"), F.lit("0.00")), F.lit(suffix))
    return F.when(c.isNotNull() & ~F.isnan(c.cast("double")), text).otherwise("")


def to_json_value(df: DataFrame, cols: Sequence[str] | None = None, name: str = "value") -> DataFrame:
    """One JSON text per row."""
    return df.select(F.to_json(F.struct(*[quoted(c) for c in (cols or df.columns)])).alias(name))


def from_json_value(df: DataFrame, schema: T.StructType, name: str = "value") -> DataFrame:
    return df.select(F.from_json(quoted(name), schema).alias("r")).select("r.*")


def split_series(col: Column | str, undefined: str = "-", strict: bool = False) -> Column:
    """Blank-separated numbers to an array; the undefined sign becomes null."""
    parts = F.split(F.trim(F.regexp_replace(_c(col), r"\s+", " ")), " ")
    convert = (lambda t: t.cast("double")) if strict else (lambda t: t.try_cast("double"))
    return F.transform(parts, lambda t: convert(F.nullif(t, F.lit(undefined))))


def parse_coordinates(col: Column | str) -> Column:
    """``lng,lat,ele`` to a struct of doubles; anything else is an error."""
    c = _c(col)
    parts = F.split(c, ",")
    checked = F.when(F.size(parts) == 3, parts).otherwise(
        F.raise_error(F.concat(F.lit("cannot parse coordinates: "), c)).cast("array<string>"))
    return F.struct(
        checked[0].cast("double").alias("lng"),
        checked[1].cast("double").alias("lat"),
        checked[2].cast("double").alias("ele"),
    )
