"""Scalar column expressions (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def as_key(x) -> Column:
    """Id / token text: ``str(v)`` of the value; a missing value is the text 'None'."""
    return F.coalesce(c(x).cast("string"), F.lit("None"))


def epoch_micros(x) -> Column:
    """Microseconds since the epoch; TIMESTAMP_NTZ is read as UTC wall time."""
    return F.unix_micros(c(x).cast("timestamp"))


def lenient_double(x) -> Column:
    """Unparsable text, NULL and NaN all become NULL."""
    v = F.expr(f"try_cast({_sql(x)} as double)") if isinstance(x, str) else c(x).cast("double")
    return F.when(F.isnan(v), F.lit(None).cast("double")).otherwise(v)


def _sql(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def sigmoid(x) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-c(x)))


def clamp(x, lo=None, hi=None) -> Column:
    out = c(x)
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi))
    return out


def md5_uniform_int(*parts) -> Column:
    """First 15 hex digits of md5('p1|p2|...') as a non-negative BIGINT (0 .. 2^60-1)."""
    text = F.concat_ws("|", *[c(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def md5_unit(*parts) -> Column:
    """Deterministic value in [0, 1) from md5 of the parts: 52 bits, exact in a double."""
    return F.shiftright(md5_uniform_int(*parts), 8).cast("double") / F.lit(float(1 << 52))


def resolve_k(k, default: int, n_items) -> Column:
    """Request size: default when null, then clamped to [1, n_items]."""
    return F.least(F.greatest(F.coalesce(c(k).cast("bigint"), F.lit(default)), F.lit(1)),
                   c(n_items).cast("bigint"))
