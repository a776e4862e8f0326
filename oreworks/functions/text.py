"""Text clean-up and masking of personal data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as maskable.
CARD_DIGITS = r"\d(?=\d{4})"
CARD_DIGITS_ANY_SEPARATOR = r"\d(?=(?:[ -]?\d){4})"
ACCOUNT_CHARS = r"(?<=.{3}).(?=.*@)"
ACCOUNT_HEAD = 3
# What ends a line, and characters that take two UTF-16 units.
AFTER_LINE_END = r"(?<=[\n\r\u0085\u2028\u2029])"
LONG_CHARACTER = r"[\x{10000}-\x{10FFFF}]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tidy(c: Column | str) -> Column:
    """Text without the spaces around it."""
    return F.trim(_col(c))


def tidy_upper(c: Column | str) -> Column:
    """Text without the spaces around it, in upper case."""
    return F.upper(F.trim(_col(c)))


def mask_card(c: Column | str) -> Column:
    """In every run of digits, stars for all but the last four."""
    return F.regexp_replace(_col(c), CARD_DIGITS, "*")


def mask_card_strict(c: Column | str) -> Column:
    """As ``mask_card``, but spaces and dashes do not interrupt a number."""
    return F.regexp_replace(_col(c), CARD_DIGITS_ANY_SEPARATOR, "*")


def mask_account(c: Column | str) -> Column:
    """Stars between the third character and the last ``@`` of every line.

    The pattern looks ahead from every character, which is quadratic in the length of
    a line, so lines are cut by position instead, in time linear in the text. Only text with
    characters of two UTF-16 units, where the pattern may look back on half of one, goes
    through the pattern.
    """
    text = _col(c)
    plain = (F.octet_length(text) == F.length(text)) & ~(
        F.contains(text, F.lit("\n")) | F.contains(text, F.lit("\r"))
    )
    by_line = F.array_join(F.transform(F.split(text, AFTER_LINE_END, -1), _mask_line), "")
    return (
        F.when(~F.contains(text, F.lit("@")), text)
        .when(plain, _mask_line(text))
        .when(F.rlike(text, F.lit(LONG_CHARACTER)), F.regexp_replace(text, ACCOUNT_CHARS, "*"))
        .otherwise(by_line)
    )


def _mask_line(line: Column) -> Column:
    """Stars between the third character and the last ``@``. A line may end with its break."""
    last_at = F.length(line) - F.instr(F.reverse(line), "@")
    masked = F.concat(
        F.substring(line, 1, ACCOUNT_HEAD),
        F.repeat(F.lit("*"), last_at - ACCOUNT_HEAD),
        F.substr(line, last_at + 1),
    )
    return F.when(F.contains(line, F.lit("@")) & (last_at > ACCOUNT_HEAD), masked).otherwise(line)
