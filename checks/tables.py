"""The driver tables, and the résumé view derived from ``orders`` in Spark and in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmill.plans import resume_values as v
from rowmill.session import ship_package

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with its checking SQL if there is one."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(key: Column, values: list) -> Column:
    """Value number ``key % len(values)``."""
    chosen = F
    for i, value in enumerate(values):
        value = value if isinstance(value, Column) else F.lit(value).cast("string")
        chosen = chosen.when(key % len(values) == i, value)
    return chosen


def resumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, u = F.col("o_orderkey"), F.col("o_custkey")
    age = 18 + k % 45
    word = F.when(age % 10 == 1, "год").when((age % 10).between(2, 4), "года").otherwise("лет")
    amount = (20000 + (k * 37) % 180000) * F.when(k % 97 == 0, 100).otherwise(1)
    units = [" руб.", " руб", " USD", " EUR", " KZT", " бел. руб.", ""]
    months = (1 + k % 11).cast("string")
    experience = [
        F.concat(F.lit("Опыт работы "), (5 + k % 10).cast("string"), F.lit(" лет "), months, F.lit(" месяцев")),
        F.concat((2 + k % 3).cast("string"), F.lit(" года")),
        F.concat(months, F.lit(" месяцев")),
        None,
    ]
    titles = [
        "Junior developer", "Младший аналитик", "Senior разработчик", "Ведущий инженер",
        "Менеджер по продажам", "QA тестировщик", "Директор", "Бухгалтер",
    ]
    return table(spark, sf_dir, "orders").select(
        k.alias("row_id"),
        F.concat(_pick(k, ["Мужчина", "Женщина", ""]), F.lit(", "), age.cast("string"), F.lit(" "), word).alias(v.GENDER_AGE),
        F.when(k % 50 != 0, F.concat(amount.cast("string"), _pick(k, units))).alias(v.SALARY),
        _pick(u, titles).alias(v.TITLE),
        _pick(k, ["Москва , не готов к переезду", "Санкт-Петербург", "Казань, готов", "Минск", None]).alias(v.CITY),
        F.col("o_orderpriority").alias("Занятость"),
        _pick(k, experience).alias(v.EXPERIENCE),
        _pick(k, ["Высшее", "Неполное высшее", "Среднее общее", "неполное", "школа", None]).alias(v.EDUCATION),
        _pick(u, ["Высшее техническое", "Среднее", "Высшее IT"]).alias(v.SCHOOL),
        _pick(k, ["Готов", "не готов", "редко", "без командировок", None]).alias(v.TRIPS),
        F.when(k % 4 == 0, "Имеется собственный автомобиль").otherwise("Не указано").alias(v.CAR),
    )


# The same view for DuckDB, with short column names: a CTE list to put after WITH.
RESUMES_SQL = """
resumes AS (
  SELECT o_orderkey AS row_id, o_custkey AS u,
    CASE o_orderkey % 3 WHEN 0 THEN 'Мужчина' WHEN 1 THEN 'Женщина' ELSE '' END || ', ' || (18 + o_orderkey % 45) || ' ' ||
      CASE WHEN (18 + o_orderkey % 45) % 10 = 1 THEN 'год'
           WHEN (18 + o_orderkey % 45) % 10 BETWEEN 2 AND 4 THEN 'года' ELSE 'лет' END AS gender_age,
    CASE WHEN o_orderkey % 50 <> 0 THEN
      CAST((20000 + (o_orderkey * 37) % 180000) * CASE WHEN o_orderkey % 97 = 0 THEN 100 ELSE 1 END AS VARCHAR) ||
      CASE o_orderkey % 7 WHEN 0 THEN ' руб.' WHEN 1 THEN ' руб' WHEN 2 THEN ' USD' WHEN 3 THEN ' EUR'
        WHEN 4 THEN ' KZT' WHEN 5 THEN ' бел. руб.' ELSE '' END END AS salary,
    CASE o_custkey % 8 WHEN 0 THEN 'Junior developer' WHEN 1 THEN 'Младший аналитик' WHEN 2 THEN 'Senior разработчик'
      WHEN 3 THEN 'Ведущий инженер' WHEN 4 THEN 'Менеджер по продажам' WHEN 5 THEN 'QA тестировщик'
      WHEN 6 THEN 'Директор' ELSE 'Бухгалтер' END AS title,
    CASE o_orderkey % 5 WHEN 0 THEN 'Москва , не готов к переезду' WHEN 1 THEN 'Санкт-Петербург'
      WHEN 2 THEN 'Казань, готов' WHEN 3 THEN 'Минск' END AS city,
    o_orderpriority AS employment,
    CASE o_orderkey % 4
      WHEN 0 THEN 'Опыт работы ' || (5 + o_orderkey % 10) || ' лет ' || (1 + o_orderkey % 11) || ' месяцев'
      WHEN 1 THEN (2 + o_orderkey % 3) || ' года' WHEN 2 THEN (1 + o_orderkey % 11) || ' месяцев' END AS experience,
    CASE o_orderkey % 6 WHEN 0 THEN 'Высшее' WHEN 1 THEN 'Неполное высшее' WHEN 2 THEN 'Среднее общее'
      WHEN 3 THEN 'неполное' WHEN 4 THEN 'школа' END AS education,
    CASE o_custkey % 3 WHEN 0 THEN 'Высшее техническое' WHEN 1 THEN 'Среднее' ELSE 'Высшее IT' END AS school,
    CASE o_orderkey % 5 WHEN 0 THEN 'Готов' WHEN 1 THEN 'не готов' WHEN 2 THEN 'редко'
      WHEN 3 THEN 'без командировок' END AS trips,
    CASE WHEN o_orderkey % 4 = 0 THEN 'Имеется собственный автомобиль' ELSE 'Не указано' END AS car
  FROM orders
)"""


def amount_sql(belarus: str = "РУБ.") -> str:
    """CTE ``amounts``: the salary text of ``resumes`` converted to base currency."""
    return f"""
numbers AS (
  SELECT *, upper(salary) AS s,
    coalesce(TRY_CAST(nullif(replace(regexp_replace(salary, '[^0-9.,]', '', 'g'), ',', '.'), '') AS DOUBLE), 0.0) AS n
  FROM resumes
), amounts AS (
  SELECT *, n * CASE WHEN contains(s, 'USD') OR contains(s, '$') THEN 90.0
      WHEN contains(s, 'EUR') OR contains(s, '€') THEN 100.0
      WHEN contains(s, 'KZT') OR contains(s, '₸') THEN 0.2
      WHEN contains(s, 'BYN') OR contains(s, '{belarus}') THEN 30.0 ELSE 1.0 END::DOUBLE AS base
  FROM numbers
)"""


# CTE ``typed``: the basic features of ``amounts``.
TYPED_SQL = """
parts AS (
  SELECT *, coalesce(TRY_CAST(regexp_extract(gender_age, '([0-9]+)\\s*год', 1) AS BIGINT), -1) AS age,
    coalesce(TRY_CAST(regexp_extract(experience, '([0-9]+)\\s*лет', 1) AS BIGINT), 0) * 12
      + coalesce(TRY_CAST(regexp_extract(experience, '([0-9]+)\\s*месяц', 1) AS BIGINT), 0) AS months,
    coalesce(trim(split_part(city, ',', 1)), '') AS city_clean,
    lower(education) AS e, lower(trips) AS t, lower(title) AS ti, lower(school) AS sc
  FROM amounts
), typed AS (
  SELECT *,
    CASE WHEN contains(gender_age, 'Мужчина') THEN 'Мужчина' WHEN contains(gender_age, 'Женщина') THEN 'Женщина'
      ELSE 'Не указано' END AS gender,
    CASE WHEN age < 0 THEN 'Не указано' WHEN age < 25 THEN '18-24' WHEN age < 35 THEN '25-34' WHEN age < 45 THEN '35-44'
      WHEN age < 55 THEN '45-54' ELSE '55+' END AS age_group,
    CASE WHEN months <= 0 THEN 'Нет опыта' WHEN months <= 12 THEN 'До 1 года' WHEN months <= 36 THEN '1-3 года'
      WHEN months <= 60 THEN '3-5 лет' WHEN months <= 120 THEN '5-10 лет' ELSE 'Более 10 лет' END AS experience_group,
    CASE WHEN contains(car, 'Имеется') THEN 1 ELSE 0 END AS has_car,
    CASE WHEN e IS NULL THEN 'Не указано' WHEN contains(e, 'высшее') OR contains(e, 'вуз') THEN 'Высшее'
      WHEN contains(e, 'среднее') OR contains(e, 'техникум') OR contains(e, 'колледж') THEN 'Среднее специальное'
      WHEN contains(e, 'неполное') THEN 'Неполное высшее' WHEN contains(e, 'школа') THEN 'Среднее общее'
      ELSE 'Другое' END AS education_level,
    CASE WHEN t IS NULL THEN 'Не указано'
      WHEN contains(t, 'готов') OR contains(t, 'часто') OR contains(t, 'регулярно') THEN 'Частые'
      WHEN contains(t, 'редко') OR contains(t, 'иногда') THEN 'Редкие' WHEN contains(t, 'нежелательно') THEN 'Не готов'
      WHEN contains(t, 'не имеет') OR contains(t, 'без командировок') THEN 'Без командировок'
      ELSE 'По договоренности' END AS trip_frequency
  FROM parts
)"""
