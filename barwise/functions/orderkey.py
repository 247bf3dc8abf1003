"""Several order columns as one fixed-width value.

Spark keeps an aggregate in a hash table only if its buffers have a fixed
width; ``min_by`` over a struct does not, so the whole input is sorted by
group. A decimal of 38 digits has a fixed width and room for 126 bits, which
holds a time and an id, or two keys and a price. ``packed`` puts the columns
behind one another in such a decimal, so that it orders like the columns do,
nulls first, and first and last rows become hash aggregates with a map-side
partial step.

Whole numbers and times take the bits of their type, or fewer if declared; a
value that its declared bits cannot hold stops the job, it is never cut.
Prices (doubles, decimals) are ordered at a declared resolution: nearer
values tie, and values beyond the bits tie at the end of the range.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

CAPACITY = 126
_KEY = "decimal(38,0)"


class Part(NamedTuple):
    """An order column, the bits its values take, and for prices the steps per unit.

    Whole numbers: 0 <= value < 2 ** bits. Prices: -2 ** (bits - 1) <= value * per < 2 ** (bits - 1).
    """

    column: str
    bits: int
    per: int = 1 << 20


# Bits of the types (times: microseconds of the years 1 to 9999, around 1970).
_BITS = {T.BooleanType: 1, T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.DateType: 23, T.LongType: 64,
         T.TimestampType: 59, T.TimestampNTZType: 59}
_PRICES = (T.FloatType, T.DoubleType, T.DecimalType)
PRICE_BITS = 62


def is_fixed(kind: T.DataType) -> bool:
    """Whether a hash aggregate can hold a value of this type."""
    return type(kind) in _BITS or isinstance(kind, _PRICES)


def _whole(n: int) -> Column:
    return F.lit(Decimal(n)).cast(_KEY)


def _micros(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    # A zone-free time by its own fields: no session zone comes in.
    clock = F.hour(c).cast("long") * 3_600_000_000 + F.minute(c).cast("long") * 60_000_000 + (F.date_part(F.lit("SECOND"), c) * 1_000_000).cast("long")
    return F.unix_date(c.cast("date")).cast("long") * 86_400_000_000 + clock


def _number(part: Part, kind: T.DataType, declared: bool) -> Column:
    """The column as a number of 0 .. 2 ** bits - 1 in its order."""
    c = F.col(part.column)
    if isinstance(kind, _PRICES):
        steps = F.floor(c.cast("double") * float(part.per))
        top = 1 << (part.bits - 1)
        # NaN is the largest double; rounding at 2^62 and above could leave the range.
        steps = F.least(F.greatest(F.when(F.isnan(c.cast("double")), F.lit(top - 1)).otherwise(steps), F.lit(-top)), F.lit(top - 1))
        return steps.cast(_KEY) + _whole(top)
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        c = _micros(c, kind)
    elif isinstance(kind, T.DateType):
        c = F.unix_date(c)
    elif isinstance(kind, T.BooleanType):
        c = c.cast("int")
    if declared:
        stop = F.raise_error(F.lit(f"order column {part.column}: a value does not fit {part.bits} bits")).cast(_KEY)
        return F.when((c >= 0) & (c < _whole(2 ** part.bits)), c.cast(_KEY)).when(c.isNotNull(), stop)
    return c.cast(_KEY) + _whole(2 ** (part.bits - 1))


def parts_of(schema: T.StructType, order: Sequence[str | Part]) -> list[Part] | None:
    """``order`` with the bits of each part; None where a type has no fixed width or the key is full."""
    out = []
    for p in order:
        kind = schema[p.column if isinstance(p, Part) else p].dataType
        if not is_fixed(kind):
            return None
        out.append(p if isinstance(p, Part) else Part(p, PRICE_BITS if isinstance(kind, _PRICES) else _BITS[type(kind)]))
    return out if sum(p.bits + 1 for p in out) <= CAPACITY else None


def packed(schema: T.StructType, order: Sequence[str | Part], tie: Column | None = None) -> Column:
    """One value that orders rows as the columns of ``order`` do, one after the other, nulls first.

    ``tie``: a number (such as a hash) whose low bits fill what is left of the key and decide between equal rows.
    """
    parts = parts_of(schema, order)
    if parts is None:
        raise ValueError(f"order {[p if isinstance(p, str) else p.column for p in order]} does not fit {CAPACITY} bits: declare narrower parts")
    key, used = None, 0
    for p, given in zip(parts, order):
        # One bit more than the values take, for null.
        number = F.coalesce(_number(p, schema[p.column].dataType, isinstance(given, Part)) + _whole(1), _whole(0))
        key = number if key is None else key * _whole(2 ** (p.bits + 1)) + number
        used += p.bits + 1
    left = min(CAPACITY - used, 62)
    if tie is not None and left:
        low = tie.bitwiseAND(F.lit((1 << left) - 1)).cast(_KEY)
        key = low if key is None else key * _whole(1 << left) + low
    return key.cast(_KEY)


def order_key(schema: T.StructType, order: Sequence[str | Part]) -> Column:
    """The order as a fixed-width value where that is possible, else as a struct."""
    names = [p.column if isinstance(p, Part) else p for p in order]
    if len(names) == 1:
        return F.col(names[0])
    return packed(schema, order) if parts_of(schema, order) else F.struct(*names)
