"""Column cleaning expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from quantspark.functions.numeric import col

# Titles that mark a high-signal insider (matched
# case-insensitively as substrings).
HIGH_SIGNAL_TITLES = ("CEO", "CFO", "COO", "CTO", "Director", "President", "10% Owner",
                      "Chairman", "VP", "General Counsel")


def to_double(c: str | Column) -> Column:
    """Lenient numeric cast, bad text -> NULL (ANSI ``cast`` would raise)."""
    return col(c).try_cast("double")


def money(c: str | Column) -> Column:
    """Strip ``$ + ,``, ``(`` -> ``-``, drop ``)``; percent is not divided."""
    s = F.regexp_replace(col(c), r"[$+,]", "")
    s = F.regexp_replace(F.regexp_replace(s, r"\(", "-"), r"\)", "")
    return F.trim(s).try_cast("double")


def percent_fraction(c: str | Column) -> Column:
    """``'+12.5%'`` -> 0.125."""
    s = F.regexp_replace(col(c), r"[%$+,]", "")
    return F.trim(s).try_cast("double") / 100


def money_loose(c: str | Column) -> Column:
    """P5: strip ``$ , % + > <``; blank or ``-`` -> NULL; percent kept as number."""
    s = F.trim(F.regexp_replace(col(c), r"[$,%+><]", ""))
    return F.when((s == "") | (s == "-"), None).otherwise(s.try_cast("double"))


def lenient_date(c: str | Column) -> Column:
    """Parse text or timestamp leniently, normalise to the date."""
    x = col(c)
    return F.to_date(F.coalesce(x.try_cast("timestamp"), F.try_to_timestamp(x.cast("string"))))


def yyyymmdd(c: str | Column) -> Column:
    """``yyyyMMdd`` integers/strings to DATE, junk -> NULL."""
    s = col(c).cast("string")
    return F.when(F.trim(s).rlike(r"^\d{8}$"), F.try_to_timestamp(F.trim(s), F.lit("yyyyMMdd"))).cast("date")


def norm_ticker(c: str | Column) -> Column:
    """Trim + upper."""
    return F.upper(F.trim(col(c)))


def strip_word(c: str | Column, word: str) -> Column:
    """Remove a substring anywhere (``str.replace``), then trim."""
    return F.trim(F.replace(col(c), F.lit(word), F.lit("")))


def zero_pad(c: str | Column, width: int) -> Column:
    return F.lpad(col(c).cast("string"), width, "0")


def keyword_flag(c: str | Column, words: Sequence[str] = HIGH_SIGNAL_TITLES) -> Column:
    """1 if any word occurs case-insensitively, else 0 (null text -> 0)."""
    lowered = F.lower(F.coalesce(col(c), F.lit("")))
    hit = F.lit(False)
    for w in words:
        hit = hit | F.contains(lowered, F.lit(w.lower()))
    return hit.cast("int")


def bool_text_to_int(c: str | Column) -> Column:
    """'True'/'true'/True -> 1, else 0."""
    return F.when(F.lower(col(c).cast("string")) == "true", 1).otherwise(0)
