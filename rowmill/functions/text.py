"""Free-text functions: cleaning, numbers and keyword rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space in the Unicode sense, with the ASCII separators. Java's plain \s stops at ASCII and would
# leave no-break spaces behind; an explicit list of code points is several times slower to match.
UNICODE = "(?U)"
WHITESPACE = r"[\s\x1C-\x1F]"
BYTE_ORDER_MARK = "\ufeff"

Rules = Sequence[tuple[str, Sequence[str]]]


def named(name: str) -> Column:
    """Column by its exact name, whatever punctuation the name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def clean_text(text: Column) -> Column:
    """Collapse white-space runs to one space, trim, and drop byte order marks. Null stays null."""
    collapsed = F.regexp_replace(text, f"{UNICODE}{WHITESPACE}+", " ")
    return F.replace(F.trim(collapsed), F.lit(BYTE_ORDER_MARK), F.lit(""))


def extract_number(text: Column) -> Column:
    """The digits of ``text`` read as one number, comma or dot as decimal mark; 0.0 if unreadable."""
    digits = F.translate(F.regexp_replace(text, "[^0-9.,]", ""), ",", ".")
    return F.coalesce(_parsed(digits, "double"), F.lit(0.0))


def number_before(text: Column, unit: str) -> Column:
    """First integer that stands directly before ``unit``; null if there is none."""
    return _parsed(F.regexp_extract(text, f"{UNICODE}([0-9]+){WHITESPACE}*{unit}", 1), "bigint")


def _parsed(digits: Column, kind: str) -> Column:
    # a failed cast costs an exception inside the JVM, so the common case of no digits is sorted out first
    return F.nullif(digits, F.lit("")).try_cast(kind)


def contains_any(text: Column, keywords: Sequence[str]) -> Column:
    """True if any keyword occurs in ``text``; false for null."""
    return F.coalesce(reduce(or_, [text.contains(word) for word in keywords]), F.lit(False))


def flag(condition: Column) -> Column:
    """0/1 integer of a condition, null counted as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def first_rule(text: Column, rules: Rules, default: Column | None = None) -> Column:
    """Value of the first rule with a keyword in ``text``; ``default`` (or null) if none has."""
    chain = F
    for value, keywords in rules:
        chain = chain.when(contains_any(text, keywords), F.lit(value))
    return chain if default is None else chain.otherwise(default)


def last_rule(text: Column, rules: Rules, default: Column | None = None) -> Column:
    """Like :func:`first_rule`, but a later matching rule overrides an earlier one."""
    return first_rule(text, list(rules)[::-1], default)


def before_comma(text: Column) -> Column:
    """Text before the first comma, trimmed of white space; empty for null."""
    head = F.substring_index(text, ",", 1)
    return F.coalesce(F.regexp_replace(head, f"{UNICODE}^{WHITESPACE}+|{WHITESPACE}+$", ""), F.lit(""))


def to_base_currency(text: Column, rules: Rules, rates: Mapping[str, float]) -> Column:
    """Amount in ``text`` converted by the rate of the first currency rule that matches.

    A currency without a rate, and text without a currency, count as base currency. The rate table is
    a plan-time parameter, so it becomes a literal map rather than a join.
    """
    amount = extract_number(text)
    if not rates:
        return amount
    currency = first_rule(F.upper(text), rules)
    table = F.create_map(*[F.lit(part) for code, rate in rates.items() for part in (code, float(rate))])
    return amount * F.coalesce(F.try_element_at(table, currency), F.lit(1.0))
