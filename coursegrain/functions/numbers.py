"""Number reading and display."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import let
from .text import clean

_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def to_number(c: Column) -> Column:
    """Plain decimal text to DOUBLE; NULL for anything else (no ``1d``, ``0x..``, ``nan``)."""
    raw = clean(c)
    return F.when(raw.rlike(_NUMBER), raw.try_cast("double"))


def to_int(c: Column, default: int = 0) -> Column:
    raw = clean(c)
    return F.coalesce(F.when(raw.rlike(r"^[+-]?[0-9]+$"), raw.try_cast("int")), F.lit(default))


def _trim_zeros(c: Column) -> Column:
    return F.when(F.contains(c, F.lit(".")), F.regexp_replace(c, r"\.?0+$", "")).otherwise(c)


def _exact_six_digits(x: Column) -> Column:
    """1 <= |x| < 10^6 at six significant digits, rounded on the exact binary value.

    The 52 fraction bits are scaled as DECIMAL(38,0), so comparing the remainder
    with one half has no rounding of its own.
    """
    wide = "decimal(38,0)"
    size = F.abs(x)
    unit = F.lit(1 << 52).cast(wide)

    def rounded(scaled: Column, whole: Column, scale: Column) -> Column:
        rest = scaled % unit
        kept = whole * scale + ((scaled - rest) / unit).cast("bigint")
        twice = rest * F.lit(2)
        return kept + F.when((twice > unit) | ((twice == unit) & (kept % 2 == 1)), 1).otherwise(0)

    def spelled(total: Column, places: Column) -> Column:
        digits = total.cast("string")
        split_at = F.length(digits) - places
        body = F.concat(F.substr(digits, F.lit(1), split_at), F.lit("."), F.substr(digits, split_at + 1, places))
        return (
            F.when((places == 0) & (total >= 1000000), "1e+06")
            .when(places == 0, digits)
            .otherwise(_trim_zeros(body))
        )

    def at(places: Column) -> Column:
        whole = F.floor(size)
        scale = F.element_at(F.array(*[F.lit(10**k).cast("bigint") for k in range(6)]), places + 1)
        scaled = ((size - whole) * F.lit(float(1 << 52))).cast("bigint").cast(wide) * scale.cast("decimal(6,0)")
        return let(let(scaled, lambda v: rounded(v, whole, scale)), lambda total: spelled(total, places))

    return F.concat(
        F.when(x < 0, "-").otherwise(""),
        let(F.lit(6) - F.length(F.floor(size).cast("string")), at),
    )


def _by_exponent(x: Column, science: Column, exponent: Column) -> Column:
    size = F.abs(exponent).cast("string")
    power = F.when(F.length(size) < 2, F.concat(F.lit("0"), size)).otherwise(size)
    scientific = F.concat(
        _trim_zeros(F.regexp_extract(science, r"^([^e]+)e", 1)), F.lit("e"),
        F.when(exponent < 0, "-").otherwise("+"), power,
    )
    pattern = F.concat(F.lit("%."), (F.lit(5) - exponent).cast("string"), F.lit("f"))
    return F.when(
        (exponent >= -4) & (exponent < 0), _trim_zeros(F.call_function("format_string", pattern, x))
    ).otherwise(scientific)


def general_format(x: Column) -> Column:
    """Six significant digits without trailing zeros (C's ``%g``)."""
    other = let(
        F.format_string("%.5e", x),
        lambda s: _by_exponent(x, s, F.regexp_extract(s, r"e([+-]?\d+)$", 1).try_cast("int")),
    )
    return (
        F.when(x == 0, "0")
        .when((F.abs(x) >= 1) & (F.abs(x) < 1000000), _exact_six_digits(x))
        .otherwise(other)
    )


def format_points(c: Column) -> Column:
    """``10.000`` -> ``10``, ``7.50`` -> ``7.5``; other text is left as it is."""

    def shown(raw: Column, x: Column) -> Column:
        return (
            F.when(x.isNull(), raw)
            .when(x == 0, "0")
            .when(x == F.floor(x), F.format_string("%.0f", x))
            .otherwise(general_format(x))
        )

    return let(clean(c), lambda raw: let(to_number(raw), lambda x: shown(raw, x)))


def format_bytes(n: Column) -> Column:
    x = n.cast("double")
    one = lambda size: F.format_string("%.1f", F.bround(x / size, 1))  # noqa: E731  an exact half goes to the even digit
    out = F.when(x < 1024, F.concat(n.cast("long").cast("string"), F.lit(" B")))
    for unit, size in (("KB", 1024.0), ("MB", 1024.0 ** 2)):
        out = out.when(x < size * 1024, F.concat(one(size), F.lit(f" {unit}")))
    return out.otherwise(F.concat(one(1024.0 ** 3), F.lit(" GB")))
