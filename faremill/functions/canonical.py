"""Canonical text of values and rows, for exact comparison of two tables.

A value becomes a tagged pair: ["null"], ["bool",true], ["integer","7"],
["float","0x1.8000000000000p+1"] or ["text","..."]. Floats are written in hexadecimal, so
no digit is lost, signed zeros differ and every NaN is the same; integer widths do not
matter. A row is the JSON array of its pairs.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATS = (T.FloatType, T.DoubleType)

# Hexadecimal digits of a double after the point.
_DIGITS = 13


def kind_of(data_type: T.DataType) -> str:
    """Tag of a column type; types outside the five kinds are refused."""
    if isinstance(data_type, T.NullType):
        return "null"
    if isinstance(data_type, T.BooleanType):
        return "bool"
    if isinstance(data_type, _INTEGERS):
        return "integer"
    if isinstance(data_type, _FLOATS):
        return "float"
    if isinstance(data_type, T.StringType):
        return "text"
    raise TypeError(f"no canonical form for {data_type.simpleString()}")


def is_negative_zero(value: Column) -> Column:
    # Arithmetic and grouping treat both zeros alike; only the text shows the sign.
    return F.when(value == 0, value.cast("string") == "-0.0").otherwise(F.lit(False))


def float_hex(value: Column) -> Column:
    """Hexadecimal text of a double, exact: all 13 digits and a signed exponent."""
    value = value.cast("double")
    short = F.format_string("%a", value)
    exponent = F.regexp_extract(short, "p(.+)$", 1)
    full = F.concat(
        F.regexp_extract(short, r"^(-?0x[01]\.)", 1),
        F.rpad(F.regexp_extract(short, r"\.([0-9a-f]+)p", 1), _DIGITS, "0"),
        F.lit("p"), F.when(exponent.startswith("-"), F.lit("")).otherwise(F.lit("+")), exponent,
    )
    return (
        F.when(F.isnan(value), F.lit("nan"))
        .when(value == float("inf"), F.lit("inf"))
        .when(value == float("-inf"), F.lit("-inf"))
        .when(value == 0, F.when(is_negative_zero(value), F.lit("-0x0.0p+0")).otherwise(F.lit("0x0.0p+0")))
        .when(value.isNotNull(), full)
    )


def json_text(value: Column) -> Column:
    """A JSON string literal in ASCII; other characters become \\uXXXX units."""
    units = F.regexp_extract_all(F.lower(F.hex(F.encode(value, "UTF-16BE"))), F.lit("(....)"), F.lit(1))
    # The short escapes of JSON.
    short = F.create_map(*[
        F.lit(part) for pair in {
            "0022": '\\"', "005c": "\\\\", "0008": "\\b", "0009": "\\t",
            "000a": "\\n", "000c": "\\f", "000d": "\\r",
        }.items() for part in pair
    ])
    escaped = F.transform(units, lambda unit: F.coalesce(
        F.try_element_at(short, unit),
        F.when(unit.between("0020", "007e"), F.char(F.conv(unit, 16, 10).cast("long"))),
        F.concat(F.lit("\\u"), unit),
    ))
    plain = ~value.rlike(r'[^ -~]|["\\]')
    body = F.when(plain, value).when(value.isNotNull(), F.concat_ws("", escaped))
    return F.concat(F.lit('"'), body, F.lit('"'))


def canonical_value(value: Column, kind: str) -> Column:
    """The tagged pair of a value; a value of kind `tagged` is one already."""
    if kind == "tagged":
        return value
    if kind == "null":
        return F.lit('["null"]')
    if kind == "bool":
        body = value.cast("string")
    elif kind == "integer":
        body = F.concat(F.lit('"'), value.cast("string"), F.lit('"'))
    elif kind == "float":
        body = F.concat(F.lit('"'), float_hex(value), F.lit('"'))
    else:
        body = json_text(value)
    return F.coalesce(F.concat(F.lit(f'["{kind}",'), body, F.lit("]")), F.lit('["null"]'))


def canonical_record(kinds: dict[str, str]) -> Column:
    """The JSON array of a row's tagged values; `kinds` names the columns in order."""
    values = [canonical_value(F.col(name), kind) for name, kind in kinds.items()]
    return F.concat(F.lit("["), F.concat_ws(",", *values), F.lit("]"))


def kinds_of(df: DataFrame, columns: list[str] | None = None) -> dict[str, str]:
    return {name: kind_of(df.schema[name].dataType) for name in columns or df.columns}
