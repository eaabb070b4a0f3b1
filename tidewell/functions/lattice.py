"""Types ordered by what they can hold, and the types that text can be read as.

``wider`` joins two types in the lattice

    int < bigint < decimal < double < string,  date < timestamp < string,  boolean < string

where a type that has seen no value yet is below all others.  Structs are joined field by
field, arrays and maps by their elements; what has nothing else in common is a string.  Joining
is associative and commutative up to the order of fields, so parts of an input may be
joined in any order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    NullType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

_WHOLE = [ByteType, ShortType, IntegerType, LongType]
_DIGITS = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 20}
_MOST_DIGITS = 38


def _decimals(a: DecimalType, b: DecimalType) -> DataType:
    scale = max(a.scale, b.scale)
    digits = max(a.precision - a.scale, b.precision - b.scale) + scale
    return DecimalType(digits, scale) if digits <= _MOST_DIGITS else DoubleType()


def _numbers(a: DataType, b: DataType) -> DataType | None:
    kinds = type(a), type(b)
    numbers = [*_WHOLE, DecimalType, FloatType, DoubleType]
    if not all(k in numbers for k in kinds):
        return None
    if all(k in _WHOLE for k in kinds):
        return max((a, b), key=lambda t: _WHOLE.index(type(t)))
    if FloatType in kinds or DoubleType in kinds:
        return a if kinds == (FloatType, FloatType) else DoubleType()
    return _decimals(*(t if isinstance(t, DecimalType) else DecimalType(_DIGITS[type(t)], 0) for t in (a, b)))


def wider(a: DataType, b: DataType) -> DataType:
    """The least type that holds the values of both."""
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    if isinstance(a, StructType) and isinstance(b, StructType):
        return joined(a, b)
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        return ArrayType(wider(a.elementType, b.elementType), a.containsNull or b.containsNull)
    if isinstance(a, MapType) and isinstance(b, MapType):
        return MapType(wider(a.keyType, b.keyType), wider(a.valueType, b.valueType), True)
    kinds = {type(a), type(b)}
    if kinds == {DateType, TimestampType}:
        return TimestampType()
    if kinds == {DateType, TimestampNTZType}:
        return TimestampNTZType()
    return _numbers(a, b) or StringType()


def joined(a: StructType, b: StructType) -> StructType:
    """All fields by name: those of ``a`` in their order, then the new ones of ``b``."""
    others = {f.name: f for f in b.fields}
    fields = []
    for field in a.fields:
        other = others.pop(field.name, None)
        kind = field.dataType if other is None else wider(field.dataType, other.dataType)
        fields.append(StructField(field.name, kind, True, field.metadata))
    return StructType([*fields, *[StructField(f.name, f.dataType, True, f.metadata) for f in others.values()]])


def settled(kind: DataType) -> DataType:
    """The type with strings where no value was ever seen."""
    if isinstance(kind, NullType):
        return StringType()
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, settled(f.dataType), True, f.metadata) for f in kind.fields])
    if isinstance(kind, ArrayType):
        return ArrayType(settled(kind.elementType), True)
    if isinstance(kind, MapType):
        return MapType(settled(kind.keyType), settled(kind.valueType), True)
    return kind


def known_fields(kind: StructType) -> StructType:
    """The fields that have seen a value, at any depth; a type may still be found for the others."""
    fields = []
    for f in kind.fields:
        inner = known_fields(f.dataType) if isinstance(f.dataType, StructType) else f.dataType
        if not isinstance(inner, NullType) and (not isinstance(inner, StructType) or inner.fields):
            fields.append(StructField(f.name, settled(inner), True, f.metadata))
    return StructType(fields)


def as_type(column: Column, held: DataType, wanted: DataType) -> Column:
    """A value in a wider type; fields of structs are found by name, and new ones are null."""
    if held == wanted:
        return column
    if isinstance(held, StructType) and isinstance(wanted, StructType):
        kinds = {f.name: f.dataType for f in held.fields}
        fields = [
            (as_type(column[f.name], kinds[f.name], f.dataType) if f.name in kinds else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in wanted.fields
        ]
        return F.when(column.isNotNull(), F.struct(*fields))
    if isinstance(held, ArrayType) and isinstance(wanted, ArrayType):
        return F.transform(column, lambda x: as_type(x, held.elementType, wanted.elementType))
    if isinstance(held, MapType) and isinstance(wanted, MapType):
        values = F.transform_values(column, lambda _, v: as_type(v, held.valueType, wanted.valueType))
        return F.transform_keys(values, lambda k, _: as_type(k, held.keyType, wanted.keyType))
    if isinstance(wanted, StringType) and isinstance(held, (StructType, ArrayType, MapType)):
        return F.to_json(column)
    return column.cast(wanted)


# What a value has to look like before a cast decides: casts alone would take 2024 for
# a date and 12d for a number.
_LOOKS = {
    "int": r"^[+-]?\d+$",
    "bigint": r"^[+-]?\d+$",
    "decimal(38,0)": r"^[+-]?\d+$",
    "double": r"^([+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|NaN|[+-]?Infinity)$",
    "date": r"^\d{4}-\d{1,2}-\d{1,2}$",
    "timestamp": r"^\d{4}-\d{1,2}-\d{1,2}([ T].+)?$",
    "boolean": r"^(?i:true|false)$",
}
_FOUND = [
    ("int", IntegerType()),
    ("bigint", LongType()),
    ("decimal(38,0)", DecimalType(38, 0)),
    ("double", DoubleType()),
    ("date", DateType()),
    ("timestamp", TimestampType()),
    ("boolean", BooleanType()),
]


def read_as(text: Column, kind: str) -> Column:
    """Text as a value of a type; null where it does not look like one."""
    if kind == "string":
        return text
    looks = _LOOKS.get("decimal(38,0)" if kind.startswith("decimal") and kind.endswith(",0)") else kind, "")
    value = text.try_cast(kind)
    return F.when(text.rlike(looks), value) if looks else value


def fits_all(column: Column) -> Column:
    """Aggregate: for each type of the lattice whether it holds all values, and whether there are any."""
    fits = [F.coalesce(F.every(F.when(column.isNotNull(), read_as(column, kind).isNotNull())), F.lit(True)).alias(kind) for kind, _ in _FOUND]
    return F.struct(F.coalesce(F.some(column.isNotNull()), F.lit(False)).alias("any"), *fits)


def least_type(fits: Sequence[bool]) -> DataType:
    """The least type of what ``fits_all`` found."""
    some, *each = fits
    if not some:
        return NullType()
    return next((kind for (_, kind), fit in zip(_FOUND, each) if fit), StringType())
