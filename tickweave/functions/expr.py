"""Column expressions (all JVM built-ins, so they stay inside whole-stage codegen)."""
from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The cost model of the spread analysis, in percent.
TRADING_FEE = 0.2
SLIPPAGE = 0.1
MIN_PROFIT = 0.5
LABEL_CUT = 0.8
# Python floats on purpose: 0.2 + 0.1 is 0.30000000000000004 in doubles, so the
# 0.3 rung of the ladder is "not profitable", exactly as in double arithmetic.
TOTAL_COST = TRADING_FEE + SLIPPAGE
PROFITABLE_CUT = TOTAL_COST + MIN_PROFIT

_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def bucket_seconds(bucket: str | int) -> int:
    """'1 minute', '5 minutes', '1 hour', ... or plain seconds -> seconds."""
    if isinstance(bucket, int):
        return bucket
    m = re.fullmatch(r"\s*(\d+)\s*(second|minute|hour|day)s?\s*", bucket.lower())
    if not m:
        raise ValueError(f"unsupported bucket {bucket!r}")
    return int(m.group(1)) * _UNIT_SECONDS[m.group(2)]


def col_name(exchange: str, field: str) -> str:
    """Wide-table column name, e.g. ``BINANCE:high``."""
    return f"{exchange}:{field}"


def c(name: str) -> Column:
    """Column by a name that may contain ':'."""
    return F.col(f"`{name}`")


def nan_to_null(x: Column) -> Column:
    """pandas has one missing value; Spark has NULL and NaN. Keep only NULL."""
    return F.nanvl(x, F.lit(None).cast("double"))


def safe_div(num: Column, den: Column) -> Column:
    """Division that gives NULL (not an error or inf) for a zero denominator."""
    return F.try_divide(num, den)


def pct_of(diff: Column, base: Column) -> Column:
    return safe_div(diff, base) * F.lit(100.0)


# The wording of the two directions and the two point colours.
def direction(diff: Column, ex1: str, ex2: str) -> Column:
    """Positive difference: sell on the first venue; zero or negative: on the second."""
    return (F.when(diff > 0, F.lit(f"SELL {ex1}, BUY {ex2}"))
            .otherwise(F.lit(f"SELL {ex2}, BUY {ex1}")))


def parity_class(diff: Column) -> Column:
    """Chart colour of a parity-scatter point."""
    return F.when(diff > 0, F.lit("red")).otherwise(F.lit("green"))


def net_profit_topk(diff: Column, price2: Column, cost: float = TOTAL_COST) -> Column:
    """Net profit per unit as listed next to the top spreads."""
    return F.abs(diff) - price2 * F.lit(cost) / F.lit(100.0)


def net_profit_total(abs_pct: Column, price2: Column, cost: float = TOTAL_COST) -> Column:
    """Net profit per unit as summed over the profitable rows."""
    return (abs_pct - F.lit(cost)) * price2 / F.lit(100.0)


# Epoch microseconds accepted as times: years 1 to 9999, what a timestamp prints as.
MIN_EPOCH_MICROS, MAX_EPOCH_MICROS = -62_135_596_800_000_000, 253_402_300_800_000_000


def micros_to_ntz(micros: Column, low: int = MIN_EPOCH_MICROS, high: int = MAX_EPOCH_MICROS) -> Column:
    """Epoch microseconds (double) -> naive UTC; NULL outside ``[low, high)`` instead of an
    overflow error (one bad value must not fail a whole load)."""
    ok = (micros >= F.lit(float(low))) & (micros < F.lit(float(high)))
    return F.when(ok, F.timestamp_micros(F.round(micros).cast("long"))).cast("timestamp_ntz")


def epoch_to_ntz(value: Column, unit: Column | str) -> Column:
    """Epoch number (as text or number) in 'ms', 's' or fractional 's' -> naive UTC."""
    unit_col = F.lit(unit) if isinstance(unit, str) else unit
    num = value.cast("string").try_cast("double")
    micros = (F.when(unit_col == "ms", num * F.lit(1000.0))
              .when(unit_col == "s", num * F.lit(1_000_000.0)))
    return micros_to_ntz(micros)


def floor_time(t: Column, seconds: int) -> Column:
    """Floor a naive timestamp to a bucket that is a whole number of seconds."""
    step = F.lit(seconds * 1_000_000)
    micros = F.unix_micros(t.cast("timestamp"))
    return F.timestamp_micros(micros - F.pmod(micros, step)).cast("timestamp_ntz")
