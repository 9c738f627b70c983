"""Scans, cleaning and the scalar features of the résumé view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.tables import RESUMES_SQL, TYPED_SQL, amount_sql, query, resumes, table
from rowmill.functions.numeric import text_to_number
from rowmill.functions.text import clean_text, named, to_base_currency
from rowmill.operators.columns import union_all
from rowmill.operators.dedupe import drop_duplicate_rows
from rowmill.operators.joins import align
from rowmill.operators.summary import value_summary
from rowmill.operators.target import fit_amount_treatment
from rowmill.plans import resume_values as v
from rowmill.plans.programs import read_records
from rowmill.plans.resume_features import advanced_features, basic_features, with_base_currency
from rowmill.sources.csv import read_csv, write_csv
from rowmill.sources.matrix import read_matrix, verify_written, write_matrix
from rowmill.sources.metadata import (
    feature_metadata,
    read_feature_names,
    write_feature_metadata,
    write_feature_names,
)
from rowmill.storage import materialize, new_path

AMOUNTS_SQL = f"WITH {RESUMES_SQL}, {amount_sql()}"
FEATURES_SQL = f"{AMOUNTS_SQL}, {TYPED_SQL}"


@query(
    "q_csv_scan",
    "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "customer-csv")
    write_csv(table(spark, sf_dir, "customer"), path)
    return read_csv(spark, path)


@query(
    "q_csv_multiline_split",
    """SELECT doc_id, strlen(text) AS n_bytes, md5(text) AS digest, 'say "' || lang || '",' || chr(10) AS quoted FROM documents""",
)
def csv_multiline_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with line breaks and quotes through one file that is read in many ranges."""
    path, small = new_path(spark, "texts-csv"), "spark.sql.files.maxPartitionBytes"
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.concat(F.lit('say "'), "lang", F.lit('",\n')).alias("quoted"))
    write_csv(docs.coalesce(1), path)
    before = spark.conf.get(small)
    spark.conf.set(small, "256k")
    try:
        read = materialize(read_csv(spark, path, null_texts=()), "texts")
    finally:
        spark.conf.set(small, before)
    return read.select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), F.md5("text").alias("digest"), "quoted")


@query(
    "q_csv_seats",
    """SELECT o_orderkey AS k, CAST(9000000000000000000 + o_orderkey AS BIGINT) AS id,
    (o_orderkey % 40) || CASE WHEN o_orderkey % 2 = 0 THEN 'D' ELSE 'F' END AS seat, '99999999999999999999' || o_orderkey AS far,
    CAST(o_orderkey % 7 AS VARCHAR) || 'e2' = '3e2' AS three FROM orders""",
)
def csv_seats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that a cast would take for numbers, and whole numbers at and beyond the end of bigint."""
    k = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders").select(
        k.alias("k"), (k + F.lit(9_000_000_000_000_000_000)).alias("id"), F.concat((k % 40).cast("string"), F.when(k % 2 == 0, "D").otherwise("F")).alias("seat"),
        F.concat(F.lit("99999999999999999999"), k.cast("string")).alias("far"), F.concat((k % 7).cast("string"), F.lit("e2")).alias("three"),
    )
    path = new_path(spark, "seats-csv")
    write_csv(orders, path)
    return read_csv(spark, path).withColumn("three", F.col("three") == 300.0)


@query(
    "q_number_texts",
    """SELECT o_orderkey AS row_id, CASE o_orderkey % 8 WHEN 0 THEN 12.0 WHEN 1 THEN 1000.0 WHEN 2 THEN NULL WHEN 3 THEN NULL
      WHEN 4 THEN NULL WHEN 5 THEN -0.5 WHEN 6 THEN NULL ELSE 7.25 END::DOUBLE AS number FROM orders""",
)
def number_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = F.array(*map(F.lit, [" 12 ", "1e3", "12d", "7F", "", "-.5", "1 2", "7.25"]))
    orders = table(spark, sf_dir, "orders")
    text = F.element_at(texts, (F.col("o_orderkey") % 8 + 1).cast("int"))
    return orders.select(F.col("o_orderkey").alias("row_id"), text_to_number(text).alias("number"))


@query(
    "q_row_ids_of_files",
    """SELECT label, count(*) AS rows, count(DISTINCT k) AS keys FROM (
      SELECT o_orderkey AS k, o_orderpriority AS label FROM orders) GROUP BY label""",
)
def row_ids_of_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two files that both count from 0; every record meets its own label again, and only that."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    path = new_path(spark, "two-files")
    for part in (0, 1):
        half = orders.where(F.col("o_orderkey") % 2 == part)
        half.select(F.floor(F.col("o_orderkey") / 2).alias("_c0"), F.col("o_orderkey").alias("k"), F.col("o_orderpriority").alias("label")).write.option("header", True).csv(f"{path}/{part}")
    records = read_records(spark, [f"{path}/0", f"{path}/1"])
    joined = align(records.select("row_id", "k"), records.select("row_id", "label", F.col("k").alias("other")), "row_id")
    return joined.where("k = other").groupBy("label").agg(F.count("*").alias("rows"), F.count_distinct("k").alias("keys"))


@query(
    "q_union_inputs",
    """SELECT c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal, c_mktsegment AS mktsegment FROM customer
    UNION ALL SELECT s_name, s_nationkey, s_acctbal, NULL FROM supplier""",
)
def union_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").drop("c_custkey")
    suppliers = table(spark, sf_dir, "supplier").drop("s_suppkey")
    return union_all([t.toDF(*[c[2:] for c in t.columns]) for t in (customers, suppliers)])


@query(
    "q_feature_metadata",
    """SELECT position, name, dtype, 6 AS feature_count, (SELECT count(*) FROM orders) AS row_count FROM (VALUES
    (0, 'o_orderkey', 'bigint'), (1, 'o_custkey', 'bigint'), (2, 'o_orderstatus', 'string'), (3, 'o_totalprice', 'double'),
    (4, 'o_orderdate', 'timestamp_ntz'), (5, 'o_orderpriority', 'string')) AS m(position, name, dtype)""",
)
def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "metadata")
    orders = table(spark, sf_dir, "orders")
    write_feature_metadata(orders, path)
    return spark.read.schema(feature_metadata(orders).schema).json(path)


@query(
    "q_feature_names",
    """SELECT p_partkey AS row_key, CAST(p_size AS DOUBLE) AS p_size, p_retailprice, CAST(p_size AS DOUBLE) * 2 AS feature_3
    FROM part""",
)
def feature_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "names")
    write_feature_names(spark, ["row_key", "p_size", "p_retailprice"], path)
    size = F.col("p_size").cast("double")
    unnamed = table(spark, sf_dir, "part").select("p_partkey", size, "p_retailprice", size * 2)
    return unnamed.toDF(*read_feature_names(spark, [f"{path}/missing", path], len(unnamed.columns)))


@query("q_roundtrip_matrix", "SELECT p_partkey, CAST(p_size AS DOUBLE) AS p_size, p_retailprice FROM part")
def roundtrip_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "matrix")
    write_matrix(table(spark, sf_dir, "part"), path, ["p_size"], "p_retailprice", "p_partkey")
    return read_matrix(spark, path)


@query(
    "q_written_check",
    "SELECT count(*) AS rows, 3 AS columns, TRUE AS rows_match, TRUE AS columns_match FROM part",
)
def written_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "matrix")
    parts = table(spark, sf_dir, "part")
    write_matrix(parts, path, ["p_size"], "p_retailprice", "p_partkey")
    return verify_written(spark, path, ["p_partkey", "p_size", "p_retailprice"], parts.count())


@query(
    "q_short_write",
    "SELECT count(*) AS rows, 3 AS columns, FALSE AS rows_match, TRUE AS columns_match FROM part WHERE p_partkey % 10 <> 0",
)
def short_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A matrix that lost rows after it was counted is told from the one that was sent."""
    path = new_path(spark, "matrix")
    parts = table(spark, sf_dir, "part")
    sent = write_matrix(parts, path, ["p_size"], "p_retailprice", "p_partkey")
    short = new_path(spark, "matrix")
    spark.read.parquet(path).where("p_partkey % 10 <> 0").write.parquet(short)
    return verify_written(spark, short, ["p_partkey", "p_size", "p_retailprice"], sent)


@query("q_dedupe", "SELECT DISTINCT text, lang, source, n_chars FROM documents")
def dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_duplicate_rows(table(spark, sf_dir, "documents").drop("doc_id"))


@query(
    "q_dedupe_keep_id",
    "SELECT min(doc_id) AS doc_id, text, lang, source, n_chars FROM documents GROUP BY text, lang, source, n_chars",
)
def dedupe_keep_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_duplicate_rows(table(spark, sf_dir, "documents"), row_id="doc_id")


SPACE_SQL = r"[\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


@query(
    "q_clean_text",
    f"SELECT doc_id, replace(trim(regexp_replace(text, '{SPACE_SQL}', ' ', 'g')), chr(65279), '') AS text FROM documents",
)
def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", clean_text(F.col("text")).alias("text"))


@query("q_currency_convert", f"{AMOUNTS_SQL} SELECT row_id, coalesce(base, 0.0) AS base FROM amounts")
def currency_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_base_currency(resumes(spark, sf_dir)).select("row_id", named(v.SALARY_BASE).alias("base"))


@query(
    "q_currency_corrected",
    f"WITH {RESUMES_SQL}, {amount_sql('БЕЛ')} SELECT row_id, coalesce(base, 0.0) AS base FROM amounts",
)
def currency_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount = to_base_currency(named(v.SALARY), v.CORRECTED_CURRENCY_RULES, v.RATES)
    return resumes(spark, sf_dir).select("row_id", amount.alias("base"))


@query("q_normalize_salary", f"{AMOUNTS_SQL} SELECT row_id, n AS amount FROM amounts")
def normalize_salary(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = basic_features(resumes(spark, sf_dir).select("row_id", named(v.SALARY)))
    return features.select("row_id", named(v.SALARY_NUMBER).alias("amount"))


@query(
    "q_salary_summary",
    f"""{AMOUNTS_SQL} SELECT count(*) AS n, round(min(base), 4) AS "min", round(max(base), 4) AS "max",
    round(avg(base), 4) AS mean, round(median(base), 4) AS median FROM amounts WHERE base > 0""",
)
def salary_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    amounts = with_base_currency(resumes(spark, sf_dir))
    summary = value_summary(amounts, v.SALARY_BASE, positive_only=True)
    return summary.select("n", *[F.round(c, 4).alias(c) for c in ("min", "max", "mean", "median")])


@query("q_age_gender", f"{FEATURES_SQL} SELECT row_id, age, gender, age_group FROM typed")
def age_gender(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = basic_features(resumes(spark, sf_dir))
    return features.select(
        "row_id", named(v.AGE).alias("age"), named(v.GENDER).alias("gender"), named(v.AGE_GROUP).alias("age_group")
    )


@query(
    "q_city_flags",
    f"""{FEATURES_SQL} SELECT row_id, city_clean AS city, has_car, CASE WHEN contains(lower(city_clean), 'москва')
    OR contains(lower(city_clean), 'санкт-петербург') OR contains(lower(city_clean), 'минск')
    OR contains(lower(city_clean), 'киев') OR contains(lower(city_clean), 'алматы') THEN 1 ELSE 0 END AS capital FROM typed""",
)
def city_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = advanced_features(basic_features(resumes(spark, sf_dir)))
    return features.select(
        "row_id", named(v.CITY_CLEAN).alias("city"), named(v.HAS_CAR).alias("has_car"), named(v.CAPITAL).alias("capital")
    )


@query(
    "q_experience",
    f"""{FEATURES_SQL} SELECT row_id, months, experience_group, round(months / 12.0::DOUBLE, 6) AS years,
    CASE WHEN months <= 0 THEN NULL WHEN months <= 12 THEN '0-1 год' WHEN months <= 36 THEN '1-3 года'
      WHEN months <= 60 THEN '3-5 лет' WHEN months <= 120 THEN '5-10 лет' WHEN months <= 240 THEN '10-20 лет'
      WHEN months <= 1200 THEN '20+ лет' END AS detail,
    round(age - months / 12.0::DOUBLE, 6) AS career_start FROM typed""",
)
def experience(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = advanced_features(basic_features(resumes(spark, sf_dir)))
    return features.select(
        "row_id",
        named(v.MONTHS).alias("months"),
        named(v.EXPERIENCE_GROUP).alias("experience_group"),
        F.round(named(v.YEARS), 6).alias("years"),
        named(v.EXPERIENCE_DETAIL).alias("detail"),
        F.round(named(v.CAREER_START), 6).alias("career_start"),
    )


@query(
    "q_education_trips",
    f"""{FEATURES_SQL} SELECT row_id, education_level, trip_frequency,
    CASE WHEN contains(sc, 'высшее') THEN 1 ELSE 0 END AS higher,
    CASE WHEN contains(sc, 'техническ') OR contains(sc, 'инженер') OR contains(sc, 'программист') OR contains(sc, 'it')
      OR contains(sc, 'компьютер') THEN 1 ELSE 0 END AS technical FROM typed""",
)
def education_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = advanced_features(basic_features(resumes(spark, sf_dir)))
    return features.select(
        "row_id",
        named(v.EDUCATION_LEVEL).alias("education_level"),
        named(v.TRIP_FREQUENCY).alias("trip_frequency"),
        named(v.HIGHER_EDUCATION).alias("higher"),
        named(v.TECHNICAL_EDUCATION).alias("technical"),
    )


KEYWORD_SQL = ", ".join(f"CASE WHEN contains(ti, '{w}') THEN 1 ELSE 0 END AS \"{w}\"" for w in v.TITLE_KEYWORDS)


@query("q_title_keywords", f"{FEATURES_SQL} SELECT row_id, length(title) AS title_length, {KEYWORD_SQL} FROM typed")
def title_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = advanced_features(resumes(spark, sf_dir))
    flags = [named(v.TITLE_FLAG_PREFIX + w).alias(w) for w in v.TITLE_KEYWORDS]
    return features.select("row_id", named(v.TITLE_LENGTH).alias("title_length"), *flags)


def treated_sql(threshold: str) -> str:
    """CTE ``treated``: amounts capped, on log scale, gaps filled."""
    return f"""
valid AS (SELECT *, coalesce(base, 0.0) AS b FROM typed),
cap AS (SELECT quantile_cont(b, 0.95) AS c FROM valid WHERE b > 0 AND b <= {threshold}),
logs AS (SELECT valid.*, CASE WHEN b > 0 THEN ln(1 + CASE WHEN b > {threshold} THEN c ELSE b END) END AS l FROM valid, cap),
treated AS (SELECT *, coalesce(l, (SELECT median(l) FROM logs)) AS amount FROM logs)"""


@query(
    "q_salary_outliers",
    f"{FEATURES_SQL}, {treated_sql('1000000')} SELECT row_id, round(amount, 6) AS amount FROM treated",
)
def salary_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    amounts = with_base_currency(resumes(spark, sf_dir)).select("row_id", named(v.SALARY_BASE).alias("amount"))
    amounts = materialize(amounts, "amounts")  # the fits read it several times
    treatment = fit_amount_treatment(amounts, "amount", v.IMPROVED_SALARY_THRESHOLD)
    return treatment.apply(amounts).select("row_id", F.round("amount", 6).alias("amount"))
