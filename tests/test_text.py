"""Hand-worked cases of the scalar functions."""

import pytest
from pyspark.sql import functions as F

from rowmill.functions.numeric import clip, nonzero, quality_band, right_closed_bins, signed_percent_error, step
from rowmill.functions.text import before_comma, clean_text, extract_number, named, to_base_currency
from rowmill.operators.labels import LevelRules, keep_labelled, keyword_hits, with_levels
from rowmill.plans import resume_values as v
from rowmill.plans.resume_features import (
    LEVEL_RULES,
    advanced_features,
    basic_features,
    experience_months,
    experience_years,
)


def apply(spark, values, function, kind="string"):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in rows.orderBy("i").select(function(F.col("x"))).collect()]


def test_clean_text(spark):
    cases = {
        "  a  b\t\n c ": "a b c",
        "a  b": "a b",
        "a b　c\u0085d\u001fe": "a b c d e",
        "﻿a": "a",
        "x​y": "x​y",  # a zero-width space is not white space
        "": "",
        None: None,
    }
    assert apply(spark, cases, clean_text) == list(cases.values())


def test_currency(spark):
    cases = {
        "27 000 руб.": 810000.0,
        "27 000 руб": 27000.0,
        "1500 USD": 135000.0,
        "$1,500": 135.0,
        "2 000 EUR": 200000.0,
        "300 000 KZT": 60000.0,
        "2 000 бел. руб.": 0.0,
        "40 000 грн.": 40000.0,
        "50 000-70 000 руб": 5000070000.0,
        "по договоренности": 0.0,
        None: 0.0,
    }
    assert apply(spark, cases, lambda x: to_base_currency(x, v.CURRENCY_RULES, v.RATES)) == list(cases.values())
    # a currency without a rate counts as base currency
    assert apply(spark, ["10 USD"], lambda x: to_base_currency(x, v.CURRENCY_RULES, {"EUR": 100.0})) == [10.0]
    assert apply(spark, ["10 USD"], lambda x: to_base_currency(x, v.CURRENCY_RULES, {})) == [10.0]
    assert apply(spark, ["27 000 руб."], lambda x: to_base_currency(x, v.CORRECTED_CURRENCY_RULES, v.RATES)) == [27000.0]


def test_extract_number(spark):
    cases = {"27 000 руб.": 27000.0, "2..": 0.0, "1,5": 1.5, ".5": 0.5, "": 0.0, "abc": 0.0, None: 0.0}
    assert apply(spark, cases, extract_number) == list(cases.values())


def test_age_and_gender(spark):
    texts = ["Мужчина, 42 года", "21 год", "Женщина, 25 лет", None, "99999999999999999999 год", "3 года"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, `{v.GENDER_AGE}` string")
    rows = basic_features(frame).orderBy("i").collect()
    assert [r[v.AGE] for r in rows] == [42, 21, -1, -1, -1, 3]
    assert [r[v.GENDER] for r in rows] == ["Мужчина", v.NOT_STATED, "Женщина", v.NOT_STATED, v.NOT_STATED, v.NOT_STATED]
    ages = {-1: v.NOT_STATED, 0: "18-24", 24: "18-24", 25: "25-34", 44: "35-44", 54: "45-54", 55: "55+"}
    assert apply(spark, ages, lambda x: step(x, v.AGE_CUTS, v.AGE_GROUPS), "int") == list(ages.values())


def test_experience(spark):
    cases = {"6 лет 1 месяц": 73, "3 года 2 месяца": 2, "1 год": 0, None: 0, "9999999999999999999 лет": 0}
    assert apply(spark, cases, experience_months) == list(cases.values())
    years = apply(spark, ["6 лет 6 месяцев", "3 месяца", None], experience_years)
    assert years == [6.5, 0.25, 0.0]
    groups = dict(zip([0, 12, 36, 60, 120, 121], v.MONTH_GROUPS))
    assert apply(spark, groups, lambda x: step(x, v.MONTH_CUTS, v.MONTH_GROUPS, "right"), "int") == list(groups.values())


def test_right_closed_bins(spark):
    cases = {0.0: None, 1.0: "0-1 год", 3.0: "1-3 года", 20.0: "10-20 лет", 100.0: "20+ лет", 101.0: None, None: None}
    assert apply(spark, cases, lambda x: right_closed_bins(x, v.YEAR_EDGES, v.YEAR_BINS), "double") == list(cases.values())
    with pytest.raises(ValueError):
        right_closed_bins(F.lit(1), [0, 1], ["a", "b"])


def test_education_trips_city_car(spark):
    education = {
        "Неполное высшее": "Высшее",
        "Среднее общее": "Среднее специальное",
        "неполное": "Неполное высшее",
        "школа": "Среднее общее",
        "курсы": "Другое",
        None: "Не указано",
    }
    trips = {
        "не готов": "Частые",
        "редко": "Редкие",
        "нежелательно": "Не готов",
        "без командировок": "Без командировок",
        "": "По договоренности",
        None: "Не указано",
    }
    cars = ["Имеется собственный", None, "нет", "", "Имеется", "x"]
    rows = [(i, e, t, c) for i, (e, t, c) in enumerate(zip(education, trips, cars))]
    frame = spark.createDataFrame(rows, f"i int, `{v.EDUCATION}` string, `{v.TRIPS}` string, `{v.CAR}` string")
    found = basic_features(frame)
    assert v.CAR not in found.columns
    found = found.orderBy("i").collect()
    assert [r[v.EDUCATION_LEVEL] for r in found] == list(education.values())
    assert [r[v.TRIP_FREQUENCY] for r in found] == list(trips.values())
    assert [r[v.HAS_CAR] for r in found] == [1, 0, 0, 0, 1, 0]
    assert apply(spark, ["Москва , не готов", "Минск", None, " , x"], before_comma) == ["Москва", "Минск", "", ""]


def test_advanced_features(spark):
    frame = spark.createDataFrame(
        [("Главный ИНЖЕНЕР", "Высшее (IT)", "Москва", 30, 24), (None, None, "", -1, 0)],
        f"`{v.TITLE}` string, `{v.SCHOOL}` string, `{v.CITY_CLEAN}` string, `{v.AGE}` int, `{v.MONTHS}` int",
    )
    first, second = advanced_features(frame).collect()
    assert first[v.TITLE_LENGTH] == 15 and second[v.TITLE_LENGTH] == 0
    assert first["Должность_инженер"] == 1 and first["Должность_аналитик"] == 0 and second["Должность_инженер"] == 0
    assert (first[v.HIGHER_EDUCATION], first[v.TECHNICAL_EDUCATION], first[v.CAPITAL]) == (1, 1, 1)
    assert (second[v.HIGHER_EDUCATION], second[v.TECHNICAL_EDUCATION], second[v.CAPITAL]) == (0, 0, 0)
    assert first[v.CAREER_START] == 28.0 and first[v.EXPERIENCE_DETAIL] == "1-3 года" and second[v.EXPERIENCE_DETAIL] is None


def test_absent_columns_are_skipped(spark):
    frame = spark.createDataFrame([(1,)], "other int")
    assert advanced_features(basic_features(frame)).columns == ["other"]


def test_levels(spark):
    titles = {
        "Junior developer": "middle",
        "Младший аналитик": "junior",
        "Senior разработчик": "senior",
        "International manager": "junior",
        "Бухгалтер": "unknown",
        None: "unknown",
    }
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(titles)], f"i int, `{v.TITLE}` string")
    rows = with_levels(frame, LEVEL_RULES).orderBy("i").collect()
    assert [r["level"] for r in rows] == list(titles.values())
    assert [r["in_scope"] for r in rows] == [True, False, True, False, False, False]
    for years, level in [(0.0, "junior"), (2.0, "middle"), (4.99, "middle"), (5.0, "senior")]:
        by_years = with_levels(frame.filter("i = 4"), LEVEL_RULES, F.lit(years)).first()
        assert by_years["level"] == level
    hits = {r["rule"]: r["rows"] for r in keyword_hits(frame, LEVEL_RULES).collect()}
    assert hits == {"junior": 3, "middle": 2, "senior": 1, "in scope": 2}
    # too few rows in scope: scope is ignored, unknown levels still go
    assert keep_labelled(with_levels(frame, LEVEL_RULES), LEVEL_RULES).count() == 4
    few = LevelRules(**{**LEVEL_RULES.__dict__, "min_rows": 2})
    assert keep_labelled(with_levels(frame, few), few).count() == 2


def test_levels_without_title_column(spark):
    rows = with_levels(spark.createDataFrame([(1,), (2,)], "x int"), LEVEL_RULES).collect()
    assert {(r["level"], r["in_scope"]) for r in rows} == {("middle", True)}
    alias = spark.createDataFrame([("Lead",)], "Position string")
    assert with_levels(alias, LEVEL_RULES).first()["level"] == "senior"


def test_numeric_helpers(spark):
    assert apply(spark, [0.5, 2.0, 9.0, None], lambda x: clip(x, 1.0, 5.0), "double") == [1.0, 2.0, 5.0, None]
    assert apply(spark, [5.0, 20000.0], lambda x: clip(x, low=10000.0), "double") == [10000.0, 20000.0]
    assert apply(spark, [0.0, 3.0], nonzero, "double") == [1e-10, 3.0]
    assert apply(spark, [110.0], lambda x: signed_percent_error(F.lit(100.0), x), "double") == [pytest.approx(10.0)]
    bands = {0.1: "very poor", 0.2: "moderate", 0.5: "good", 0.6: "excellent"}
    assert apply(spark, bands, quality_band, "double") == list(bands.values())


def test_names_with_punctuation(spark):
    frame = spark.createDataFrame([(1,)], ["a"]).toDF("a.b, `c`: d")
    assert frame.select(named("a.b, `c`: d")).first()[0] == 1
