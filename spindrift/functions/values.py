"""Scalar cleaning: strings, numbers, ids and times as columns.

Missing is NULL throughout: NaN becomes NULL where values come in, and conditions are closed with false.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: All that Unicode calls white space, so that stripping is more than trimming blanks.
_EDGE = r"(?U)^\s+|\s+$"


def strip(text: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(text, _EDGE, "")


def squeeze(text: Column) -> Column:
    """One blank for each run of white space or NUL, none at the ends."""
    return F.trim(F.regexp_replace(text, r"(?U)[\s\x00]+", " "))  # no white space but blanks is left


def valid_text(value: Column) -> Column:
    """The stripped text, or NULL if nothing is left or it says nan."""
    out = strip(value.cast("string"))
    return F.when((out != "") & (F.lower(out) != "nan"), out)


def safe_number(value: Column) -> Column:
    """A double; NULL for text that is no number and for NaN."""
    number = value.try_cast("double")
    return F.when(~F.isnan(number), number)


def rounded(value: Column, digits: int) -> Column:
    """Rounded half up; a negative value that rounds to zero keeps its sign, as by IEEE 754 and in SQL, which ``round`` alone drops."""
    out = F.round(value, digits)
    return F.when((out == 0) & (value < 0), F.lit(-0.0)).otherwise(out)


def case_id(*values: Column) -> Column:
    """The first value that is a number, cut to a long."""
    return F.coalesce(*[F.floor(F.abs(safe_number(v))).cast("long") * F.signum(safe_number(v)).cast("long") for v in values])


def first_valid(*values: Column, default: str | None = None) -> Column:
    return F.coalesce(*[valid_text(v) for v in values], F.lit(default))


def first_present(df: DataFrame, *names: str) -> str | None:
    """The first of the names that is a column, else the first that is one apart from case."""
    lower = {c.lower(): c for c in df.columns}
    return next((n for n in names if n in df.columns), next((lower[n.lower()] for n in names if n.lower() in lower), None))


def valid_fields(df: DataFrame, names: list[str] | None = None, prefix: str = "") -> Column:
    """A map of the valid values by column name, for chosen columns or all that begin with ``prefix``."""
    chosen = [n for n in (names or df.columns) if n in df.columns and n.startswith(prefix)]
    if not chosen:
        return F.create_map().cast("map<string,string>")
    pairs = F.create_map(*[x for n in chosen for x in (F.lit(n), valid_text(F.col(f"`{n}`")))])
    return F.map_filter(pairs, lambda k, v: v.isNotNull())


def first_fields(names: list[Column], most: int = 5) -> Column:
    """The first ``most`` valid values as an array."""
    return F.slice(F.array_compact(F.array(*[valid_text(n) for n in names])), 1, most)


def seconds_of(text: Column) -> Column:
    """Seconds from a number, MM:SS, HH:MM:SS(.fraction), or the first number in a text."""
    t = strip(text)
    part = lambda i: F.try_element_at(F.split(t, ":"), F.lit(i)).try_cast("double")
    clock = F.when(F.size(F.split(t, ":")) == 3, part(1) * 3600 + part(2) * 60 + part(3)).when(F.size(F.split(t, ":")) == 2, part(1) * 60 + part(2))
    found = F.regexp_extract(t, r"[-+]?\d+(?:\.\d+)?", 0)
    return F.when(t != "", F.coalesce(safe_number(t), clock, F.when(found != "", found).try_cast("double")))


def printable(text: Column) -> Column:
    """Without control characters, but with line feeds, carriage returns and tabs."""
    return F.regexp_replace(text, r"[\x00-\x08\x0B\x0C\x0E-\x1F]", "")


def contains_any(text: Column, words: list[str] | Column) -> Column:
    """Whether a text contains one of the words; false for NULL."""
    if isinstance(words, Column):
        return closed(F.exists(words, lambda w: F.contains(text, w)))
    return let(text, lambda x: closed(reduce(or_, [F.contains(x, F.lit(w)) for w in words], F.lit(False))))  # the text is worked out once


def one_line(text: Column, most: int) -> Column:
    """White space squeezed and cut to ``most`` characters, the last three dots if cut."""
    line = squeeze(text)
    return F.when(F.length(line) > most, F.concat(F.left(line, F.lit(most - 3)), F.lit("..."))).otherwise(line)


def fixed(value: Column, digits: int, sign: bool = False) -> Column:
    """A number with a fixed number of digits behind the point, halves to the even digit; NULL stays."""
    rounded = F.bround(value.cast("double"), digits)
    printed = F.format_string(f"%{'+' if sign else ''}.{digits}f", rounded)
    if not sign and digits <= 3:  # a decimal of few digits says the same in a fraction of the time
        printed = F.when(F.abs(rounded) < 1e12, rounded.cast(f"decimal(18,{digits})").cast("string")).otherwise(printed)
    return F.when(value.isNotNull(), printed)


def with_unit(value: Column, unit: str, digits: int = 1) -> Column:
    """A number and its unit; NA for NULL."""
    number = fixed(value, digits)
    return F.coalesce(F.concat(number, F.lit(f" {unit}")) if unit else number, F.lit("NA"))


def closed(condition: Column) -> Column:
    """Unknown counts as false."""
    return F.coalesce(condition, F.lit(False))


def let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once, however often the body uses it.

    For two values bind a struct: Catalyst takes equal expressions over the variables of nested lambdas for the same.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def those_of(*texts: Column) -> Column:
    """The texts that are not NULL, each once, in their order.

    A set difference is compiled with what it is made of; ``array_compact`` is a filter with a lambda, below which Catalyst interprets everything.
    """
    return F.array_except(F.array(*texts), F.array(F.lit(None).cast("string")))
