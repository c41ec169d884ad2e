"""Column functions that pin down SQL semantics Spark spells differently.

Every helper returns a ``Column`` built from Spark built-ins, so it stays
inside whole-stage codegen.  The behaviour each one fixes:

* ``lenient_timestamp`` / ``lenient_double``: text that does not parse
  becomes NULL; partial dates ("2018", "2018-01") and Java float suffixes
  ("1.5d", "1f") are rejected rather than guessed; "1_000" is 1000.
* ``strict_int``: whole-number text is cast, decimal text is rounded half
  away from zero, "0x"/"0b" literals are read in base 16/2, anything else
  stops the job with an error naming the value.
* ``trim_spaces``: strips every Unicode space separator (space, no-break
  space, ...) but keeps tabs and newlines.
* ``day_diff``: number of calendar-day boundaries between two timestamps.
* ``month_start``: first instant of the month, zone-less.
* ``guarded_corr``: Pearson correlation that yields NaN for constant input
  instead of raising a division-by-zero error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode "space separator" (Zs) characters that trimming
# removes, in code-point order: U+0020, U+00A0, U+1680, U+2000..U+200A,
# U+202F, U+205F, U+3000.
SPACE_SEPARATORS = (
    "\u0020\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u202f\u205f\u3000"
)

# A timestamp must at least carry year-month-day.
_DATE_PREFIX = r"^\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"
# A number ending in a Java float/double suffix ("1.5d", "2F").
_FLOAT_SUFFIX = r"[0-9.]\s*[dDfF]\s*$"
# A single underscore between two digits is a digit separator ("1_000").
_DIGIT_SEPARATOR = r"(?<=[0-9])_(?=[0-9])"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _text(c: Column | str) -> Column:
    return _col(c).cast("string")


def trim_spaces(c: Column | str) -> Column:
    return F.btrim(_text(c), F.lit(SPACE_SEPARATORS))


def normalise_lower(c: Column | str) -> Column:
    return F.lower(trim_spaces(c))


def normalise_upper(c: Column | str) -> Column:
    return F.upper(trim_spaces(c))


def lenient_timestamp(c: Column | str) -> Column:
    """Text -> TIMESTAMP_NTZ, NULL when the text is not a full date(-time)."""
    s = _text(c)
    return F.when(s.rlike(_DATE_PREFIX), s.try_cast("timestamp_ntz"))


def _without_digit_separators(s: Column) -> Column:
    return F.when(s.contains("_"), F.regexp_replace(s, _DIGIT_SEPARATOR, "")).otherwise(s)


def lenient_double(c: Column | str) -> Column:
    """Text -> DOUBLE, NULL when unparsable; 'inf'/'nan' are accepted, and
    single underscores between digits are digit separators."""
    s = _without_digit_separators(_text(c))
    return F.when(~s.rlike(_FLOAT_SUFFIX), s.try_cast("double"))


_DECIMAL = r"^\s*([+-]?)0*(\d*)\.?(\d*)(?:[eE]([+-]?\d+))?\s*$"


def _rounded_decimal(s: Column) -> Column:
    """Decimal text, with or without an exponent, as a whole number (BIGINT), half away from zero.

    The point is moved over the digits themselves, so no digit is lost to a
    fixed precision; NULL when the text is no number or has over 18 whole digits.
    Each step is bound once (a transform of a one-element array), so that the
    expression stays small; it runs only for text that is no plain integer."""

    def placed(part: Column) -> Column:
        whole, fraction = part["whole"], part["fraction"]
        # without digits before the point, the first significant one may stand anywhere behind it
        zeros = F.when(whole == "", F.length(fraction) - F.length(F.ltrim(fraction, F.lit("0")))).otherwise(0)
        power = F.coalesce(F.nullif(part["power"], F.lit("")), F.lit("0")).try_cast("int")
        return F.struct(
            part["sign"].alias("sign"),
            F.ltrim(F.concat(whole, fraction), F.lit("0")).alias("digits"),
            (F.length(whole) - zeros + power).alias("point"),
        )

    def valued(number: Column) -> Column:
        digits, point = number["digits"], number["point"]
        kept = F.rpad(F.substring(digits, F.lit(1), point), point, "0")
        up = (F.substring(digits, point + 1, F.lit(1)) >= "5").cast("long")
        size = F.when((digits == "") | (point < 0), F.lit(0).cast("long")).when(point == 0, up).when(point <= 18, kept.try_cast("long") + up)
        return F.when(number["sign"] == "-", -size).otherwise(size)

    parts = [F.regexp_extract(s, _DECIMAL, n).alias(name) for n, name in enumerate(("sign", "whole", "fraction", "power"), 1)]
    steps = F.transform(F.transform(F.array(F.struct(*parts)), placed), valued)
    return F.when(s.rlike(_DECIMAL) & s.rlike(r"^\s*[+-]?\.?\d"), F.get(steps, 0))


def strict_int(c: Column | str, name: str = "value") -> Column:
    """Text -> INT.  NULL stays NULL; decimal text rounds half away from
    zero; text that is not a number (or overflows) raises."""
    s = _without_digit_separators(_text(c))
    # unsigned hexadecimal / binary literals ("0x1F", "0b101")
    hex_digits = F.regexp_extract(s, r"^0[xX]([0-9a-fA-F]+)$", 1)
    bin_digits = F.regexp_extract(s, r"^0[bB]([01]+)$", 1)
    radix = F.coalesce(F.conv(F.nullif(hex_digits, F.lit("")), 16, 10), F.conv(F.nullif(bin_digits, F.lit("")), 2, 10))
    message = F.concat(F.lit(f"cannot cast {name} to INTEGER: '"), s, F.lit("'"))
    # the first form that reads the text; the later ones are not evaluated then
    return F.coalesce(
        s.try_cast("int"),
        _rounded_decimal(s).try_cast("int"),
        radix.try_cast("int"),
        F.when(s.isNotNull(), F.raise_error(message).cast("int")),
    )


def day_diff(start: Column | str, end: Column | str) -> Column:
    """Calendar-day boundaries from ``start`` to ``end`` (BIGINT, may be < 0)."""
    return F.datediff(_col(end), _col(start)).cast("long")


def month_start(c: Column | str) -> Column:
    """First instant of the month as TIMESTAMP_NTZ (session zone is UTC)."""
    return F.date_trunc("month", _col(c)).cast("timestamp_ntz")


def guarded_corr(x: Column | str, y: Column | str) -> Column:
    """Aggregate: Pearson correlation over rows where both sides are present.

    NULL when no such row exists; NaN when either side has zero variance
    (constant input, or a single pair); otherwise covar_pop / (sd_x * sd_y).
    """
    x, y = _col(x), _col(y)
    both = x.isNotNull() & y.isNotNull()
    xs, ys = F.when(both, x), F.when(both, y)
    pairs = F.count(F.when(both, F.lit(1)))
    ratio = F.try_divide(F.covar_pop(xs, ys), F.stddev_pop(xs) * F.stddev_pop(ys))
    return (
        F.when(pairs == 0, F.lit(None).cast("double"))
        .when(ratio.isNull(), F.lit(float("nan")))
        .otherwise(ratio)
    )
