"""Column expressions shared by every layer.

All of them are built-in Spark expressions (JVM side, whole-stage codegen);
no Python UDF is involved anywhere in the package.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martforge import schemas as S

# Word/separator tokeniser used by initcap_words: runs of letters/digits alternate
# with runs of anything else, so every token is either a word or a separator.
_WORD_OR_SEPARATOR = r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: str | Column) -> Column:
    """``NULLIF(TRIM(c), '')``."""
    return F.nullif(F.trim(col_(c)), F.lit(""))


def initcap_words(c: str | Column) -> Column:
    """Title case where every non-alphanumeric character starts a new word.

    ``home-decor & o'neil 3d`` -> ``Home-Decor & O'Neil 3d``.  Spark's own
    ``initcap`` only splits on blanks, so the string is tokenised into
    alternating word / separator runs and each run is upper-first, lower-rest.
    """
    tokens = F.regexp_extract_all(col_(c), F.lit(_WORD_OR_SEPARATOR), 1)
    cased = F.transform(tokens, lambda t: F.concat(F.upper(F.substring(t, 1, 1)), F.lower(F.substring(t, 2, 1 << 30))))
    return F.array_join(cased, "")


def strip_money(c: str | Column) -> Column:
    """Remove currency symbol and thousands separators: ``$1,234.50`` -> ``1234.50``."""
    return F.translate(col_(c), "$,", "")


def parse_money(c: str | Column, strict: bool = True) -> Column:
    """Text money -> DECIMAL(10,2); the cast rounds half away from zero.

    strict: malformed text raises (ANSI cast); otherwise it becomes NULL.
    """
    text = strip_money(c)
    return text.cast(S.MONEY) if strict else text.try_cast(S.MONEY)


def typed(c: str | Column, dtype, strict: bool = True) -> Column:
    """Explicit cast: raises on malformed input when strict, NULL otherwise."""
    return col_(c).cast(dtype) if strict else col_(c).try_cast(dtype)


def bool_allow_list(c: str | Column, words=S.OPTIN_TRUE_WORDS) -> Column:
    """TRUE only for the listed words (trim, lower); anything else, NULL included, is FALSE."""
    return F.coalesce(F.lower(F.trim(col_(c))).isin(*words), F.lit(False))


def bool_deny_list(c: str | Column, words=S.ACTIVE_FALSE_WORDS) -> Column:
    """FALSE only for the listed words (trim, lower); anything else, NULL included, is TRUE."""
    return F.when(F.lower(F.trim(col_(c))).isin(*words), F.lit(False)).otherwise(F.lit(True))


def bool_strict(c: str | Column, strict: bool = True, name: str = "boolean") -> Column:
    """Strict text -> boolean: words, unique prefixes, on/off, 1/0.

    NULL stays NULL (the NOT NULL contract is a separate check).  Other text
    raises when strict, else becomes NULL (and is reported as a reject).
    """
    v = F.lower(F.trim(col_(c)))
    bad = F.raise_error(F.concat(F.lit(f"invalid input syntax for type {name}: "), col_(c))) if strict else F.lit(None)
    return (
        F.when(v.isNull(), F.lit(None).cast("boolean"))
        .when(v.isin(*S.STRICT_TRUE_WORDS), F.lit(True))
        .when(v.isin(*S.STRICT_FALSE_WORDS), F.lit(False))
        .otherwise(bad.cast("boolean"))
    )


def uuid_text(c: str | Column, strict: bool = True) -> Column:
    """Validate and canonicalise (trim, lower-case) a UUID held as text."""
    v = F.lower(F.trim(col_(c)))
    ok = v.rlike(S.UUID_PATTERN)
    bad = F.raise_error(F.concat(F.lit("invalid input syntax for type uuid: "), col_(c))) if strict else F.lit(None)
    return F.when(v.isNull(), F.lit(None).cast("string")).when(ok, v).otherwise(bad.cast("string"))


def date_key(ts: str | Column) -> Column:
    """Smart date key YYYYMMDD as INT (arithmetic, no string formatting)."""
    t = col_(ts)
    return (F.year(t) * 10000 + F.month(t) * 100 + F.dayofmonth(t)).cast("int")


def month_start(d: str | Column) -> Column:
    """``DATE_TRUNC('month', d)::DATE``."""
    return F.trunc(F.to_date(col_(d)), "MM")


def month_diff(later: str | Column, earlier: str | Column) -> Column:
    """Whole months between two month-start dates (years*12 + months of AGE)."""
    a, b = col_(later), col_(earlier)
    return ((F.year(a) - F.year(b)) * 12 + F.month(a) - F.month(b)).cast("int")


def duration_seconds(start: str | Column, end: str | Column) -> Column:
    """``EXTRACT(EPOCH FROM end - start)::INT``: rounds to the nearest second, halves away from zero."""
    micros = F.timestamp_diff("MICROSECOND", col_(start), col_(end)).cast("decimal(20,0)")
    return F.round(micros / F.lit(1_000_000).cast("decimal(7,0)"), 0).cast("int")


def half_up(numer: Column, denom: Column, scale: int) -> Column:
    """``numer / denom`` rounded once, half away from zero, for integers and 2-decimal amounts.

    Spark's decimal quotient keeps as few as 6 decimals once its operands are wide
    sums, and rounding it again can be off by one unit.  Here both sides become
    integers (hundredths), and one integer division settles the last digit.
    """
    n = (numer.cast("decimal(30,2)") * 100).cast("decimal(32,0)")
    d = (F.nullif(denom, F.lit(0)).cast("decimal(30,2)") * 100).cast("decimal(32,0)")
    units = F.call_function("div", F.abs(n) * F.lit(2 * 10 ** scale).cast("decimal(6,0)") + F.abs(d), F.abs(d) * F.lit(2).cast("decimal(1,0)"))
    signed = (units * F.signum(n).cast("int") * F.signum(d).cast("int")).cast("decimal(20,0)")
    return (signed / F.lit(10 ** scale).cast("decimal(6,0)")).cast(f"decimal(18,{scale})")


def pct(numer: str | Column, denom: str | Column, scale: int = 2) -> Column:
    """``ROUND(100.0 * numer / NULLIF(denom, 0), scale)``, exactly (see ``half_up``); NULL on a zero or NULL denominator."""
    return half_up(col_(numer).cast("decimal(28,2)") * F.lit(100).cast("decimal(3,0)"), col_(denom), scale)


def growth_pct(current: str | Column, previous: str | Column, scale: int = 2) -> Column:
    """``ROUND(100.0 * (current - previous) / NULLIF(previous, 0), scale)``."""
    return pct(col_(current) - col_(previous), previous, scale)


def avg_round(total: str | Column, count: str | Column, scale: int) -> Column:
    """``ROUND(AVG(x), scale)`` from the exact sum and count of x (see ``half_up``)."""
    return half_up(col_(total), col_(count), scale)


def to_exact(c: str | Column) -> Column:
    """Integer column -> DECIMAL(20,0) so that arithmetic with it stays exact."""
    return col_(c).cast("decimal(20,0)")
