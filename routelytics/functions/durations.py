"""Flight-time expressions (P3 P4, Decision D3).

Times are HHMM clock values.  The original program subtracts them as plain
numbers and adds 2400 when the result is negative (a flight past
midnight); that number is what its graphs average and print as minutes.
``clock_minutes`` is the true elapsed time in minutes, offered besides.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def raw_duration(dep="dep_time", arr="arr_time") -> Column:
    """``arr - dep`` as is; negative across midnight."""
    return _c(arr) - _c(dep)


def wrapped_duration(dep="dep_time", arr="arr_time") -> Column:
    """``arr - dep``, plus 2400 when negative (the reference's edge weight)."""
    d = raw_duration(dep, arr)
    return F.when(d < 0, d + 2400).otherwise(d)


def _minutes_of_day(hhmm: Column) -> Column:
    return F.floor(hhmm / 100) * 60 + hhmm % 100


def clock_minutes(dep="dep_time", arr="arr_time") -> Column:
    """Elapsed minutes between two HHMM clock values, wrapping at midnight."""
    d = _minutes_of_day(_c(arr)) - _minutes_of_day(_c(dep))
    return F.when(d < 0, d + 1440).otherwise(d).cast("double")
