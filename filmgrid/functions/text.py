"""Text expressions: titles, money strings, flags and display formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: all white space, in any script; none of it lies beyond U+3000
SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
# Fixed value: characters that are no part of a word, that is neither letter nor number nor underscore. The ASCII class
# comes first because it settles most characters at once.
NON_WORD = r"[\W&&[^\p{L}\p{N}]]+"
# Fixed value: how a chart marks a film that is back in cinemas.
RERELEASE = r"(?:.+\d{4}\sRe-release)|(?:.+\d{2}th\sAnniversary)|(?:.+4K\sRestoration)"
#: a text in single or double quotes; possessive, so that long ones need no backtracking
QUOTED = r"""'(?:[^'\\]++|\\.)*+'|"(?:[^"\\]++|\\.)*+\""""


def strip(text: Column) -> Column:
    """Remove white space of any kind at both ends (plain ``trim`` knows only the blank)."""
    return F.btrim(text, F.lit(SPACES))


def normalise_title(title: Column) -> Column:
    """Matching form of a title: stripped, every run of non-word characters one blank, lower case."""
    return F.lower(F.regexp_replace(strip(title), NON_WORD, " "))


def is_rerelease(title: Column) -> Column:
    """1 for a re-release, anniversary or restoration, 0 otherwise, null for a null title."""
    return title.rlike("(?dU)" + RERELEASE).cast("int")


def parse_money(amount: Column) -> Column:
    """``$1,234`` as a long. Anything but a number left over is an error."""
    return F.translate(amount, "$,", "").cast("bigint")


def dash_to_zero(text: Column) -> Column:
    return F.when(text == "-", F.lit("0")).otherwise(text)


def parse_count(text: Column) -> Column:
    """``3,210`` or ``-`` as a long; strict on anything else."""
    return dash_to_zero(F.translate(text, ",", "")).cast("bigint")


def parse_weeks(text: Column) -> Column:
    """Weeks in cinemas: a dash or a missing value is 0; strict on anything else."""
    return F.coalesce(dash_to_zero(text).cast("int"), F.lit(0))


def first_token(text: Column, separator: str) -> Column:
    return F.split_part(text, F.lit(separator), F.lit(1))


def join_list(items: Column) -> Column:
    return F.array_join(items, ", ")


def contains_ignoring_case(text: Column, part: str) -> Column:
    return F.lower(text).contains(part.lower())


def remove(text: Column, part: str) -> Column:
    return F.replace(text, F.lit(part), F.lit(""))


def compact_date(text: Column) -> Column:
    """``2024-03-01`` as ``20240301``, the form used in file names."""
    return remove(text, "-")


def as_usd(amount: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(amount, 2))


def as_rating(value: Column) -> Column:
    return remove(F.format_number(value, 1), ",")


def as_count(value: Column) -> Column:
    return F.format_number(value, 0)


def week_label(week: Column) -> Column:
    """Two digits: ``01`` to ``52``."""
    return F.lpad(week.cast("string"), 2, "0")


def parse_string_list(text: Column) -> Column:
    """``['a', "b's"]`` as an array; null for anything but a list of quoted texts. Text is never evaluated.

    Quotes are single or double, a backslash keeps the character after it.
    """
    tokens = F.regexp_extract_all(text, F.lit(QUOTED), F.lit(0))
    plain = F.transform(tokens, lambda t: F.regexp_replace(F.substr(t, F.lit(2), F.length(t) - 2), r"\\(.)", "$1"))
    return F.when(F.rlike(text, F.lit(rf"^\s*\[\s*(?:(?:{QUOTED})\s*(?:,\s*|(?=\])))*+\]\s*$")), plain)
