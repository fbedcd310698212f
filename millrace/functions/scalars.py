"""Scalar rules of the log, web-request and message jobs."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the access-log pattern, nine groups, the last two optional.
ACCESS_LOG = (
    r'^([^ ]*) ([^ ]*) ([^ ]*) (-|\[[^\]]*\]) ([^ "]*|"[^"]*") (-|[0-9]*) (-|[0-9]*)'
    r'(?: ([^"]*|"[^"]*") ([^ "]*|"[^"]*"))?$'
)
ACCESS_LOG_FIELDS = ["host", "identity", "user", "time", "request", "status", "size", "referer", "agent"]


_MARK, _CUT = "\x02", "\x01"


def access_log_parts(line: Column) -> Column:
    """The nine fields of a line as an array, NULL where the whole line does not match: one match a line.

    The match is written as its groups between control characters, and these are cut. A line that holds such a
    character itself is matched group by group.
    """
    numbers = range(1, len(ACCESS_LOG_FIELDS) + 1)
    written = F.regexp_replace(line, ACCESS_LOG, _MARK + _CUT.join(f"${i}" for i in numbers))
    cut = F.when(F.startswith(written, F.lit(_MARK)), F.split(F.substring(written, 2, 1 << 30), _CUT))
    apart = F.when(line.rlike(ACCESS_LOG), F.array(*[F.regexp_extract(line, ACCESS_LOG, i) for i in numbers]))
    return F.when(line.contains(_MARK) | line.contains(_CUT), apart).otherwise(cut)


def access_log_fields(parts: Column) -> list[Column]:
    """Nine string columns of ``access_log_parts``; NULL for an absent optional field, all NULL without a match.

    Pass a column of an earlier select, so that the match is made once.
    """
    return [(F.nullif(parts[i], F.lit("")) if i > 6 else parts[i]).alias(name) for i, name in enumerate(ACCESS_LOG_FIELDS)]


def nonempty(value: Column) -> Column:
    """True for a value that is neither NULL nor ''."""
    return F.coalesce(value != "", F.lit(False))


def valid_length(text: Column) -> Column:
    """The content length as INT, or NULL for a cell the rules reject.

    Rejected: a ``;``, blank or ``,`` inside, ten or more characters that start above 1, and whatever
    is not a 32-bit integer.
    """
    too_big = (F.length(text) >= 10) & (F.substring(text, 1, 1) > "1")
    return F.when(~text.rlike("[; ,]") & ~too_big & text.rlike("^[+-]?[0-9]+$"), text.try_cast("int"))


def kib(size: Column) -> Column:
    return size / F.lit(1024.0)


def field(record: Column, index: int, sep: str = "\t") -> Column:
    """The index-th field (from 0) of a delimited record, NULL when the record is shorter."""
    return F.get(F.split(record, sep), index)


def message(time: Column, number: Column) -> Column:
    return F.concat(F.lit("Message sent at "), time.cast("string"), F.lit(":\t"), number.cast("string"))


def message_number(text: Column) -> Column:
    return field(text, 1)


def route(key: Column, partitions: int) -> Column:
    """Partition of a key: the remainder for a positive key, 0 for the rest."""
    return F.when(key > 0, key % F.lit(partitions)).otherwise(F.lit(0))


def log_scale(x: Column, domain: tuple[float, float], width: float) -> Column:
    lo, hi = math.log10(domain[0]), math.log10(domain[1])
    return (F.log10(x) - F.lit(lo)) / F.lit(hi - lo) * F.lit(float(width))


def linear_scale(x: Column, domain: tuple[float, float], out: tuple[float, float]) -> Column:
    slope = (out[1] - out[0]) / (domain[1] - domain[0])
    return F.lit(float(out[0])) + (x - F.lit(float(domain[0]))) * F.lit(slope)


def sqrt_scale(x: Column, domain_max: float, out_max: float) -> Column:
    return F.sqrt(x / F.lit(float(domain_max))) * F.lit(float(out_max))


def hash_fraction(key: Column, seed: int) -> Column:
    """A number in [0, 1) fixed by the key and the seed, the same on every engine and partitioning."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
