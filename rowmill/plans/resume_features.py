"""Résumé features: each group is one projection, and is skipped when its input column is absent."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowmill.functions.numeric import right_closed_bins, step
from rowmill.functions.text import (
    Rules,
    before_comma,
    clean_text,
    contains_any,
    extract_number,
    first_rule,
    flag,
    named,
    number_before,
    to_base_currency,
)
from rowmill.operators.columns import replace_columns, text_columns
from rowmill.operators.labels import LevelRules
from rowmill.plans import resume_values as v

LEVEL_RULES = LevelRules(
    title_aliases=v.TITLE_ALIASES,
    keywords=v.LEVEL_KEYWORDS,
    year_cuts=v.LEVEL_YEAR_CUTS,
    year_levels=v.LEVELS,
    scope_keywords=v.IT_KEYWORDS,
    fallback="middle",
)


def clean_table(df: DataFrame) -> DataFrame:
    """Clean every text column."""
    return replace_columns(df, {name: clean_text(named(name)) for name in text_columns(df)})


def with_base_currency(
    df: DataFrame, rules: Rules = v.CURRENCY_RULES, rates: Mapping[str, float] = v.RATES
) -> DataFrame:
    if v.SALARY not in df.columns:
        return df
    return df.withColumn(v.SALARY_BASE, to_base_currency(named(v.SALARY), rules, rates))


def experience_months(text: Column) -> Column:
    """Twelve per year plus the months; what is not stated (or absurdly large) counts as zero."""
    years = F.try_multiply(number_before(text, v.YEAR_UNIT), F.lit(12).cast("bigint"))
    months = number_before(text, v.MONTH_UNIT)
    zero = F.lit(0).cast("bigint")
    return F.coalesce(F.try_add(F.coalesce(years, zero), F.coalesce(months, zero)), zero)


def experience_years(text: Column) -> Column:
    years, months = (number_before(text, unit) for unit in (v.YEAR_UNIT, v.MONTH_UNIT))
    return F.coalesce(years.cast("double"), F.lit(0.0)) + F.coalesce(months / F.lit(12.0), F.lit(0.0))


def basic_features(df: DataFrame) -> DataFrame:
    """Age, gender, amount, city, experience, car, education and travel."""
    present = set(df.columns)
    new: dict[str, Column] = {}
    groups: dict[str, Column] = {}  # a second projection, so that the numbers are extracted once
    if v.GENDER_AGE in present:
        text = named(v.GENDER_AGE)
        new[v.AGE] = F.coalesce(number_before(text, v.AGE_UNIT), F.lit(-1).cast("bigint"))
        new[v.GENDER] = first_rule(text, v.GENDERS, F.lit(v.NOT_STATED))
        groups[v.AGE_GROUP] = step(named(v.AGE), v.AGE_CUTS, v.AGE_GROUPS)
    if v.SALARY_BASE in present:
        new[v.SALARY_NUMBER] = named(v.SALARY_BASE)
    elif v.SALARY in present:
        new[v.SALARY_NUMBER] = extract_number(named(v.SALARY))
    if v.CITY in present:
        new[v.CITY_CLEAN] = before_comma(named(v.CITY))
    if v.EXPERIENCE in present:
        new[v.MONTHS] = experience_months(named(v.EXPERIENCE))
        groups[v.EXPERIENCE_GROUP] = step(named(v.MONTHS), v.MONTH_CUTS, v.MONTH_GROUPS, closed="right")
    if v.CAR in present:
        new[v.HAS_CAR] = flag(contains_any(named(v.CAR), v.CAR_WORDS))
    if v.EDUCATION in present:
        new[v.EDUCATION_LEVEL] = _described(named(v.EDUCATION), v.EDUCATION_RULES, v.EDUCATION_OTHER)
    if v.TRIPS in present:
        new[v.TRIP_FREQUENCY] = _described(named(v.TRIPS), v.TRIP_RULES, v.TRIPS_OTHER)
    return replace_columns(replace_columns(df, new), groups).drop(v.CAR)


def _described(text: Column, rules: Rules, other: str) -> Column:
    found = first_rule(F.lower(text), rules, F.lit(other))
    return F.when(text.isNull(), F.lit(v.NOT_STATED)).otherwise(found)


def advanced_features(df: DataFrame) -> DataFrame:
    """Title length and keywords, finer experience, schooling, capital city, career start."""
    present = set(df.columns)
    new: dict[str, Column] = {}
    if v.TITLE in present:
        title = named(v.TITLE)
        new[v.TITLE_LENGTH] = F.coalesce(F.length(title), F.lit(0))
        for keyword in v.TITLE_KEYWORDS:
            new[v.TITLE_FLAG_PREFIX + keyword] = flag(contains_any(F.lower(title), [keyword]))
    if v.MONTHS in present:
        years = named(v.MONTHS) / F.lit(12.0)
        new[v.YEARS] = years
        new[v.EXPERIENCE_DETAIL] = right_closed_bins(years, v.YEAR_EDGES, v.YEAR_BINS)
        if v.AGE in present:
            new[v.CAREER_START] = named(v.AGE) - years
    if v.SCHOOL in present:
        school = F.lower(named(v.SCHOOL))
        new[v.HIGHER_EDUCATION] = flag(contains_any(school, v.HIGHER_WORDS))
        new[v.TECHNICAL_EDUCATION] = flag(contains_any(school, v.TECHNICAL_WORDS))
    if v.CITY_CLEAN in present:
        new[v.CAPITAL] = flag(contains_any(F.lower(named(v.CITY_CLEAN)), v.CAPITAL_CITIES))
    return replace_columns(df, new)
