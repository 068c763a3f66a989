"""Exact, order-preserving encoding of rows as bytes (built-in expressions only).

Two rows have the same bytes iff Spark calls them equal (NULL equals NULL, NaN
equals NaN, -0.0 equals 0.0), and bytes compare as the rows do, column by
column, NULL first and NaN last. Every value is its null mark and typed bytes:

* integers, dates (days), timestamps (microseconds) and day-time intervals:
  eight bytes, most significant first, sign bit flipped;
* floats: the eight bytes of the double's IEEE 754 bits, all flipped if it is negative, else the sign bit;
* decimals: sign, then digits of the full precision (complemented if negative);
* strings and binary: the bytes, a zero one written as 0x00 0x01, and an end mark 0x00 0x00;
* arrays: a mark 0x01 before each element and an end mark; structs: their fields one after
  the other; maps: the array of their entries in order of the key's bytes.

Other types (collated strings, year-month intervals, variants) go by their text.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

_SIGN = -(2**63)
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
MARK_NULL, MARK_VALUE, END = "00", "01", "0000"


def _bytes(hexed: str) -> Column:
    return F.unhex(F.lit(hexed))


def _long_bytes(c: Column) -> Column:
    """Eight bytes of a long, most significant first; order kept by flipping the sign bit."""
    return F.unhex(F.lpad(F.hex(c.bitwiseXOR(F.lit(_SIGN))), 16, "0"))


def double_bits(x: Column) -> Column:
    """The IEEE 754 bits of a finite, non-negative double, as a long.

    There is no built-in for them; the exponent comes from ``log2`` (which may be one off)
    and all other steps multiply by powers of two, so they are exact.
    """
    two = F.lit(2.0)
    near = F.floor(F.log2(x)).cast("int")
    # 2 ** near may be above x, 2 ** (near + 1) at or below it; scale in halves so neither overflows
    def scaled(e: Column) -> Column:
        half = F.floor(-e / F.lit(2)).cast("int")
        return x * F.pow(two, half.cast("double")) * F.pow(two, (-e - half).cast("double"))

    e = F.when(scaled(near) < 1.0, near - 1).when(scaled(near) >= 2.0, near + 1).otherwise(near)
    fraction = ((scaled(e) - 1.0) * F.lit(float(2**52))).cast("long")
    normal = F.shiftleft((e + 1023).cast("long"), 52) + fraction
    tiny = (x * F.lit(2.0**537) * F.lit(2.0**537)).cast("long")  # below 2 ** -1022: a multiple of 2 ** -1074
    return F.when(x == 0.0, F.lit(0).cast("long")).when(x < F.lit(2.0**-1022), tiny).otherwise(normal)


def _double_bytes(c: Column) -> Column:
    x = c.cast("double")
    inf = F.lit(float("inf"))
    bits = F.when(F.abs(x) == inf, F.lit(0x7FF0000000000000)).otherwise(double_bits(F.abs(x)))
    # of negative ones all bits are flipped; _long_bytes flips the sign bit of either
    signed = F.when(F.isnan(x), F.lit(0x7FF8000000000000)).when(x < 0.0, F.bitwise_not(bits)).otherwise(bits)
    return _long_bytes(signed)


def _decimal_bytes(c: Column, t: T.DecimalType) -> Column:
    if t.precision >= 38:  # no room for the 1 added below: by text, exact but not in order
        return _string_bytes(c.cast("string"))
    # with 1 added the text never has an exponent
    digits = F.lpad((F.abs(c) + F.lit(1).cast("decimal(1,0)")).cast("string"), t.precision + 3, "0")
    nines = F.translate(digits, "0123456789", "9876543210")
    return F.encode(F.when(c < 0, F.concat(F.lit("-"), nines)).otherwise(F.concat(F.lit("0"), digits)), "utf-8")


def _string_bytes(c: Column) -> Column:
    return F.concat(F.encode(F.replace(c, F.lit("\u0000"), F.lit("\u0000\u0001")), "utf-8"), _bytes(END))


def _micros(c: Column, t: T.DataType) -> Column:
    """Microseconds of a timestamp; of one without zone by its own calendar, not the session's."""
    if isinstance(t, T.TimestampType):
        return F.unix_micros(c)
    second = (F.date_part(F.lit("SECOND"), c) * 1_000_000).cast("long")
    return F.unix_date(c.cast("date")).cast("long") * 86_400_000_000 + (F.hour(c) * 60 + F.minute(c)).cast("long") * 60_000_000 + second


def value_bytes(c: Column, t: T.DataType) -> Column:
    """Null mark and typed bytes of one value."""
    if isinstance(t, _INTEGRAL):
        body = _long_bytes(c.cast("long"))
    elif isinstance(t, T.BooleanType):
        body = F.when(c, _bytes("01")).otherwise(_bytes("00"))
    elif isinstance(t, T.DateType):
        body = _long_bytes(F.unix_date(c).cast("long"))
    elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
        body = _long_bytes(_micros(c, t))
    elif isinstance(t, (T.FloatType, T.DoubleType)):
        body = _double_bytes(c)
    elif isinstance(t, T.DecimalType):
        body = _decimal_bytes(c, t)
    elif isinstance(t, T.BinaryType):
        body = F.concat(F.encode(F.hex(c), "utf-8"), _bytes("00"))
    elif isinstance(t, T.ArrayType):
        items = F.transform(c, lambda x: F.concat(_bytes("01"), value_bytes(x, t.elementType)))
        body = F.concat(_joined(items), _bytes("00"))
    elif isinstance(t, T.MapType):
        entries = F.array_sort(F.transform(F.map_entries(c), lambda e: F.concat(value_bytes(e["key"], t.keyType), value_bytes(e["value"], t.valueType))))
        body = F.concat(_joined(F.transform(entries, lambda x: F.concat(_bytes("01"), x))), _bytes("00"))
    elif isinstance(t, T.StructType):
        body = F.concat(_bytes("00"), *[value_bytes(c.getField(f.name), f.dataType) for f in t.fields])
    elif isinstance(t, T.NullType):
        return _bytes(MARK_NULL)
    else:
        body = _string_bytes(c if isinstance(t, T.StringType) else c.cast("string"))
    return F.when(c.isNull(), _bytes(MARK_NULL)).otherwise(F.concat(_bytes(MARK_VALUE), body))


def _joined(items: Column) -> Column:
    """The binary elements of an array, one after the other."""
    return F.aggregate(items, F.lit("").cast("binary"), lambda a, x: F.concat(a, x))


def row_bytes(schema: T.StructType, cols: list[str] | None = None) -> Column:
    """The encoding of a row's ``cols`` (default: all of them)."""
    fields = [schema[c] for c in (schema.names if cols is None else cols)]
    return F.concat(F.lit("").cast("binary"), *[value_bytes(F.col("`" + f.name.replace("`", "``") + "`"), f.dataType) for f in fields])
