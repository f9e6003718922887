"""Text parsing: numbers, salaries, ids, codes. All built-in column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagetables.functions.arrays import let

# --- fixed values -----------------------------------------------------------
#: White space as web scripts see it; Java's \s knows only the ASCII part.
WHITESPACE = (
    "\t\n\x0b\f\r \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
)
_WS = (
    r"[\s\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}"
    r"\x{3000}\x{feff}]"
)
#: "2 000 EUR/mesiac", "Od 6,5 EUR/hod."
SALARY_SINGLE = (
    rf"(?iu)^[a-z]*{_WS}*([\d, ]+){_WS}*([\w\p{{L}}\p{{M}}\p{{Zs}}]+)/(\w+)"
)
#: "35 000 - 45 000 Kč/mesiac"
SALARY_SPAN = (
    rf"(?iu)^([\d,. ]+){_WS}*-{_WS}*([\d,. ]+)([\w\p{{L}}\p{{M}}\p{{Zs}}]+)/(\w+)"
)
OFFER_ID = r"(O\d{2,})"
PERIODS = {"hod": "hour", "mesiac": "month"}
# ----------------------------------------------------------------------------

_MARK = "\x01"
_REST = r"(?s).*$"
_INT = rf"^{_WS}*([+-]?\d+)"
_HEX = rf"^{_WS}*([+-]?)0[xX]([0-9a-fA-F]+)"
_FLOAT = rf"^{_WS}*([+-]?(?:Infinity|(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?))"


def empty_to_null(text: Column) -> Column:
    # not nullif, which would evaluate its argument twice
    return let(text, lambda t: F.when(t != "", t))


def str_or_null(text: Column, allow_empty: bool = False) -> Column:
    """Empty text counts as missing unless allowed."""
    return text if allow_empty else empty_to_null(text)


def trim(text: Column) -> Column:
    return F.trim(text, F.lit(WHITESPACE))


def trim_to_null(text: Column) -> Column:
    return empty_to_null(trim(text))


def strip_whitespace(text: Column) -> Column:
    return F.regexp_replace(text, _WS + "+", "")


def parse_int_prefix(text: Column) -> Column:
    """Leading integer of a text (``"12abc"`` -> 12), NULL when there is none."""

    def from_hex(t: Column) -> Column:
        digits = F.conv(F.regexp_extract(t, _HEX, 2), 16, 10)
        return F.concat(F.regexp_extract(t, _HEX, 1), digits).try_cast("bigint")

    return let(
        text,
        lambda t: F.when(t.rlike(_HEX), from_hex(t)).otherwise(
            _digits_to_long(F.regexp_extract(t, _INT, 1))
        ),
    )


def _digits_to_long(digits: Column) -> Column:
    # try_cast throws and catches inside for every bad text, so keep empty ones away
    return let(digits, lambda d: F.when(d != "", d.try_cast("bigint")))


def parse_float_prefix(text: Column) -> Column:
    """Leading decimal number of a text (``"1.5e3x"`` -> 1500), NULL when there is none."""
    return let(
        F.regexp_extract(text, _FLOAT, 1), lambda t: F.when(t != "", t.try_cast("double"))
    )


def str_as_number(
    text: Column,
    mode: str = "float",
    remove_whitespace: bool = False,
    allow_empty: bool = False,
    separator: str | None = None,
    decimal: str | None = None,
) -> Column:
    """Text -> number by prefix; ``separator`` and ``decimal`` are regular expressions."""
    if mode not in ("int", "float"):
        raise ValueError(f"mode must be int or float, got {mode!r}")
    if remove_whitespace:
        text = strip_whitespace(text)
    text = str_or_null(text, allow_empty)
    if separator:
        text = F.regexp_replace(text, separator, "")
    if decimal:
        text = F.regexp_replace(text, decimal, ".")
    return parse_int_prefix(text) if mode == "int" else parse_float_prefix(text)


def parse_salary(text: Column, normalize_space: bool = False) -> Column:
    """Salary text -> struct(salaryRange, Lower, Upper, Currency, Period).

    A text is a single value ("Od 6,5 EUR/hod.") or a span ("901 - 1 231
    EUR/mesiac"). Bounds keep their whole part only, and an unknown period stays
    as written. ``normalize_space`` reads no-break spaces as blanks first; by
    default they end the number, as on the site's own pages.
    """

    def number(bound: Column) -> Column:
        # a bound is made of digits, blanks, commas and points: no pattern needed
        joined = F.replace(bound, F.lit(" "), F.lit(""))
        return _digits_to_long(F.substring_index(F.substring_index(joined, ",", 1), ".", 1))

    def parsed(source: Column) -> Column:
        # one replacement per pattern gives all its groups, marked off by _MARK
        single = F.regexp_replace(
            source, SALARY_SINGLE + _REST, f"{_MARK}$1{_MARK}{_MARK}$2{_MARK}$3"
        )
        span = F.regexp_replace(
            source, SALARY_SPAN + _REST, f"{_MARK}$1{_MARK}$2{_MARK}$3{_MARK}$4"
        )
        # neither pattern fits without a slash; before the first one a span has a dash and a single value none
        is_span = F.substring_index(source, "/", 1).contains("-")
        marked = F.when(is_span, span).otherwise(single)
        return F.split(F.when(source.contains("/"), marked).otherwise(source), _MARK)

    def fields(raw: Column, g: Column) -> Column:
        raw_period = F.get(g, F.lit(4))
        period = raw_period
        for phrase, name in PERIODS.items():
            period = F.when(raw_period == phrase, F.lit(name)).otherwise(period)
        return F.struct(
            empty_to_null(raw).alias("salaryRange"),
            number(F.get(g, F.lit(1))).alias("salaryRangeLower"),
            number(F.get(g, F.lit(2))).alias("salaryRangeUpper"),
            empty_to_null(F.lower(F.get(g, F.lit(3)))).alias("salaryCurrency"),
            empty_to_null(period).alias("salaryPeriod"),
        )

    def read(raw: Column) -> Column:
        source = F.regexp_replace(raw, _WS, " ") if normalize_space else raw
        return let(source, lambda t: let(parsed(t), lambda g: fields(raw, g)))

    return let(text, read)


def default_salary_period(value: Column) -> Column:
    """No period given: three digits and more are a monthly salary."""
    return F.when(value >= 100, F.lit("month")).otherwise(F.lit("hour"))


def offer_id(url: Column) -> Column:
    return empty_to_null(F.regexp_extract(url, OFFER_ID, 1))


def codes_in_text(text: Column, phrases: dict[str, str]) -> Column:
    """Codes whose phrase occurs in the text (case-sensitive), in table order."""
    found = F.array(*[F.when(text.contains(p), F.lit(code)) for code, p in phrases.items()])
    return F.array_compact(found)


def last_change_type(text: Column, added: str) -> Column:
    """``added`` for the one known phrase, ``modified`` for everything else and for none."""
    return F.when(F.lower(text).eqNullSafe(added), F.lit("added")).otherwise(F.lit("modified"))


def result_count(text: Column, total_mark: str = "z") -> Column:
    """"1-20 z 20 345" -> struct(total, lowerPageEnd, upperPageEnd); no text -> NULL."""

    def number(part: Column) -> Column:
        return F.coalesce(
            str_as_number(part, "int", remove_whitespace=True), F.lit(0).cast("bigint")
        )

    def parts(sides: Column) -> Column:
        return let(F.split(F.get(sides, F.lit(0)), "-"), lambda bounds: F.struct(
            number(F.get(sides, F.lit(1))).alias("total"),
            number(F.get(bounds, F.lit(0))).alias("lowerPageEnd"),
            F.when(F.size(bounds) > 1, number(F.get(bounds, F.lit(1)))).alias("upperPageEnd"),
        ))

    return let(text, lambda t: F.when(t != "", let(F.split(t, total_mark), parts)))
