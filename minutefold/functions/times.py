"""Wall clocks and time bins. All of it assumes a UTC session (config.prepare)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Microseconds per unit.
UNIT_MICROS = {
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
}


def step_micros(every: str) -> int:
    """Length of a bin such as ``"1 minute"`` or ``"15 seconds"``, in microseconds."""
    amount, unit = every.split()
    micros = int(amount) * UNIT_MICROS[unit.lower().rstrip("s")]
    if micros <= 0:
        raise ValueError(f"a bin needs a positive length: {every!r}")
    return micros


def bin_index(ts: Column, step: int) -> Column:
    """Number of the left-closed bin that holds ``ts``, counted from 1970-01-01."""
    micros = F.unix_micros(ts.cast("timestamp"))
    return _whole(micros - F.pmod(micros, F.lit(step)), step)


def bin_start(index: Column, step: int, kind: T.DataType | None = None) -> Column:
    """Left edge of a bin, as TIMESTAMP_NTZ unless another type is asked for."""
    edge = F.timestamp_micros(index * F.lit(step))
    return edge.cast(kind or T.TimestampNTZType())


def _whole(dividend: Column, divisor: int) -> Column:
    return F.call_function("div", dividend, F.lit(divisor))


def to_utc_ntz(col: Column, instant: bool = False) -> Column:
    """Text with an offset, or an instant, as its UTC wall clock.

    The step over TIMESTAMP matters: a direct cast of text to TIMESTAMP_NTZ drops
    the offset instead of applying it. Text that does not begin with a full date
    raises: a cast would take a bare time for one of the current day. ``instant``
    says that the column is no text and needs no look at it.
    """
    clock = col.cast("timestamp").cast("timestamp_ntz")
    if instant:
        return clock
    dated = F.rlike(col.cast("string"), F.lit(r"^\s*[+-]?[0-9]{4,6}-[0-9]{1,2}-[0-9]{1,2}"))
    bad = F.raise_error(F.concat(F.lit("no date in "), col.cast("string")))
    return F.when(col.isNull() | dated, clock).otherwise(bad.cast("timestamp_ntz"))


def trunc_ntz(col: Column, unit: str) -> Column:
    """``date_trunc`` that stays TIMESTAMP_NTZ, so that joins on it need no cast."""
    return F.date_trunc(unit, col).cast("timestamp_ntz")
