"""Column expressions (scalar functions F1-F24). All are JVM expressions
that stay inside whole-stage codegen; none calls Python per row."""

from __future__ import annotations



from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "FLAT_THRESHOLD", "SENTIMENT_SIGNS", "LABELS", "DIRECTIONS",
    "col_of", "to_utc_day", "day_of_week", "shift_day", "day_before", "fmt",
    "norm_text", "nonblank", "text_len", "literal_pattern", "word_pattern", "has_term",
    "term_start", "clamp", "pct", "scaled_conf", "label_from_return", "sentiment_sign",
    "fill_once", "round6", "direction_index",
]

# Fixed values that define results.
FLAT_THRESHOLD = 0.3  # |return| <= 0.3 % is FLAT (inclusive)
SENTIMENT_SIGNS = {"positive": 1, "negative": -1, "neutral": 0}
LABELS = ("positive", "negative", "neutral")
DIRECTIONS = ("DOWN", "FLAT", "UP")  # sorted order = encoded index 0, 1, 2


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_utc_day(c) -> Column:
    """ISO text or timestamp -> DATE of the UTC day (session zone UTC)."""
    return F.to_date(col_of(c).try_cast("timestamp"))


def day_of_week(c) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(col_of(c))


def shift_day(c, n: int) -> Column:
    """date plus n days (n may be negative)."""
    return F.date_add(col_of(c), n)


def day_before(a, b) -> Column:
    """the UTC day of a is before the UTC day of b."""
    return to_utc_day(a) < to_utc_day(b)


def fmt(c, pattern: str = "yyyy-MM-dd") -> Column:
    """format a date or timestamp as text."""
    return F.date_format(col_of(c), pattern)


def norm_text(c) -> Column:
    """cast to string, strip, lower-case."""
    return F.lower(F.trim(col_of(c).cast("string")))


def nonblank(c) -> Column:
    """Not null and not blank after trimming."""
    return F.coalesce(F.trim(col_of(c)) != F.lit(""), F.lit(False))


def text_len(c) -> Column:
    """length in characters."""
    return F.length(col_of(c))


def literal_pattern(term: str) -> str:
    """a Java regex that matches ``term`` literally."""
    return "\\Q" + term.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def word_pattern(words: str) -> str:
    """Case-insensitive, Unicode word-boundary pattern around an alternation
    of regex pieces. (?U) makes \\w and \\b Unicode-aware like Python's re."""
    return "(?iU)\\b(?:" + words + ")\\b"


def has_term(c, pattern: str) -> Column:
    """F8: regex test; pattern written with word_pattern for \\b semantics."""
    return col_of(c).rlike(pattern)


def term_start(text, term) -> Column:
    """1-based start of the first whole-word, case-insensitive match of
    the literal ``term`` column in ``text``; 0 when absent."""
    pat = F.concat(F.lit("(?iU)\\b\\Q"), F.replace(col_of(term), F.lit("\\E"), F.lit("\\E\\\\E\\Q")),
                   F.lit("\\E\\b"))
    return F.regexp_instr(col_of(text), pat)


def clamp(c, lo: float, hi: float) -> Column:
    """min/max clamp."""
    return F.least(F.greatest(col_of(c), F.lit(lo)), F.lit(hi))


def pct(a, b) -> Column:
    """(a / b - 1) * 100, NULL when b is 0 or a side is NULL."""
    a, b = col_of(a), col_of(b)
    return F.when(b != 0, (a / b - 1) * 100)


def scaled_conf(c, d: float) -> Column:
    """min(|x| / d, 1)."""
    return F.least(F.abs(col_of(c)) / F.lit(d), F.lit(1.0))


def label_from_return(c, t: float = FLAT_THRESHOLD) -> Column:
    """UP above +t, DOWN below -t, FLAT in [-t, t], NULL for NULL."""
    c = col_of(c)
    return (F.when(c.isNull(), F.lit(None).cast("string"))
            .when(c > t, "UP").when(c < -t, "DOWN").otherwise("FLAT"))


def sentiment_sign(c) -> Column:
    """positive 1, negative -1, neutral 0, anything else NULL."""
    c = col_of(c)
    expr = F.lit(None).cast("int")
    for label, sign in SENTIMENT_SIGNS.items():
        expr = F.when(c == label, F.lit(sign)).otherwise(expr)
    return expr


def fill_once(original, current) -> Column:
    """keep the first recorded value."""
    return F.coalesce(col_of(original), col_of(current))


def round6(c) -> Column:
    return F.round(col_of(c).cast("double"), 6)


def direction_index(c) -> Column:
    """DOWN 0, FLAT 1, UP 2 (alphabetical)."""
    c = col_of(c)
    return F.when(c == "DOWN", 0.0).when(c == "FLAT", 1.0).when(c == "UP", 2.0)



