"""Column-level scalar functions built only from JVM-side Spark expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..specs import BIGINT_MAX, BIGINT_MIN, IDENTIFIER_MAX_BYTES


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clamp_to_bigint(c: Column | str) -> Column:
    """Clamp a numeric value into the bigint range.

    Below -2^63 gives -2^63, above 2^63-1 gives 2^63-1, NULL stays NULL, fractions round
    half away from zero and NaN (which sorts above every number) gives the maximum.
    ``least``/``greatest`` are not used: they skip NULL and would turn it into a bound.
    """
    x = _col(c)
    lo, hi = F.lit(BIGINT_MIN).cast("bigint"), F.lit(BIGINT_MAX).cast("bigint")
    return (
        F.when(x.isNull(), F.lit(None).cast("bigint"))
        .when(x < F.lit(BIGINT_MIN), lo)
        .when(x > F.lit(BIGINT_MAX), hi)
        .otherwise(F.round(x).cast("bigint"))
    )


def clamp_to_bigint_py(v):
    """Driver-side twin of :func:`clamp_to_bigint` for spec values (sequence bounds)."""
    if v is None:
        return None
    if v != v:  # NaN
        return BIGINT_MAX
    if v < BIGINT_MIN:
        return BIGINT_MIN
    if v > BIGINT_MAX:
        return BIGINT_MAX
    from decimal import ROUND_HALF_UP, Decimal

    return int(Decimal(str(v)).to_integral_value(rounding=ROUND_HALF_UP))


def at_least(c: Column | str, n) -> Column:
    """Floor a value at ``n`` (P6); like the SQL ``GREATEST`` a NULL input gives ``n``."""
    return F.greatest(_col(c), F.lit(n))


def type_label(type_name: Column | str, length: Column | str, precision: Column | str,
               scale: Column | str) -> Column:
    """Render a catalogued type as ``t``, ``t(len)``, ``t(p)`` or ``t(p,s)`` (used by P5).

    Order of the rules: a type that already carries ``(`` is kept; a non-zero length wins;
    then a non-zero scale (bare type when the precision is unknown); then a non-zero
    precision; else the bare name.  A NULL length is not "non-zero" and falls through.
    """
    t, ln, p, s = (_col(x) for x in (type_name, length, precision, scale))
    with_ps = F.concat(t, F.coalesce(F.concat(F.lit("("), p.cast("string"), F.lit(","),
                                              s.cast("string"), F.lit(")")), F.lit("")))
    return (
        F.when(F.instr(t, "(") > 0, t)
        .when(ln != 0, F.concat(t, F.lit("("), ln.cast("string"), F.lit(")")))
        .when(F.coalesce(s, F.lit(0)) != 0, with_ps)
        .when(F.coalesce(p, F.lit(0)) != 0, F.concat(t, F.lit("("), p.cast("string"), F.lit(")")))
        .otherwise(t)
    )


def truncate_identifier(name: str, max_bytes: int = IDENTIFIER_MAX_BYTES) -> str:
    """Cut an identifier to ``max_bytes`` UTF-8 bytes without splitting a character."""
    raw = name.encode("utf-8")
    if len(raw) <= max_bytes:
        return name
    return raw[:max_bytes].decode("utf-8", errors="ignore")


# Fixed value: a check condition that only says "<identifier> IS NOT NULL" (whole text,
# any case, bare identifier of letters/digits/underscore or a double-quoted one) is a
# not-null rule, not a check constraint.
NOT_NULL_CONDITION = re.compile(r'^([\w]*|"[^"]*") IS NOT NULL\Z', re.IGNORECASE | re.UNICODE)


def not_null_column(condition: str | None) -> str | None:
    """Column named by a bare ``x IS NOT NULL`` condition, else ``None``."""
    if condition is None:
        return None
    m = NOT_NULL_CONDITION.match(condition)
    if not m:
        return None
    ident = m.group(1)
    return ident[1:-1] if ident.startswith('"') else ident
