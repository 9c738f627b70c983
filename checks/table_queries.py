"""Aggregates, fitted transforms, correlations and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.tables import RESUMES_SQL, TYPED_SQL, amount_sql, query, resumes, table
from rowmill.functions.text import named
from rowmill.operators.categorical import apply_binary, apply_one_hot, distinct_counts, fit_encoder
from rowmill.operators.columns import coerce_numeric
from rowmill.operators.correlation import (
    collinear_columns,
    correlation_array,
    correlation_table,
    near_duplicate_pairs,
    pair_correlations,
    strong_pairs,
    strongest,
    target_correlations,
)
from rowmill.operators.dedupe import distinct_combinations, merge_duplicate_features, reduction_report
from rowmill.operators.impute import fill_missing, fit_medians, fit_modes, prepare_features
from rowmill.operators.joins import attach_group_sizes, map_values
from rowmill.operators.outliers import count_outliers, fit_bounds, treat_outliers
from rowmill.operators.scale import apply_scaling, fit_normalizer, fit_robust, fit_standard, normalize
from rowmill.operators.split import with_fold, with_stratified_test_flag, with_test_flag
from rowmill.operators.summary import back_transformed_sample, quality_report
from rowmill.operators.target import prepare_target, target_profile
from rowmill.plans import resume_values as v
from rowmill.plans.resume_features import basic_features, clean_table, with_base_currency

FEATURES_SQL = f"WITH {RESUMES_SQL}, {amount_sql()}, {TYPED_SQL}"


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(named(c), digits) for c in columns})


# Merging duplicate feature rows


@query(
    "q_mean_amount",
    f"""{FEATURES_SQL} SELECT gender, age_group, city_clean AS city, experience_group, round(avg(coalesce(base, 0.0)), 4) AS amount,
    count(*) AS group_size FROM typed GROUP BY gender, age_group, city_clean, experience_group""",
)
def mean_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = basic_features(with_base_currency(clean_table(resumes(spark, sf_dir))))
    keys = {v.GENDER: "gender", v.AGE_GROUP: "age_group", v.CITY_CLEAN: "city", v.EXPERIENCE_GROUP: "experience_group"}
    records = features.select(*[named(c).alias(name) for c, name in keys.items()], named(v.SALARY_NUMBER).alias("amount"))
    return rounded(merge_duplicate_features(records, "amount", size_column="group_size"), 4, "amount")


@query(
    "q_dup_aggregate",
    """SELECT l_returnflag, l_linestatus, l_quantity, round(avg(l_extendedprice), 4) AS l_extendedprice, count(*) AS group_size
    FROM lineitem GROUP BY l_returnflag, l_linestatus, l_quantity""",
)
def dup_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity", "l_extendedprice")
    merged = merge_duplicate_features(items, "l_extendedprice", size_column="group_size", sort=True)
    return rounded(merged, 4, "l_extendedprice")


@query(
    "q_dup_aggregate_null_keys",
    """SELECT flag, l_linestatus, round(avg(l_extendedprice), 4) AS l_extendedprice, count(*) AS group_size
    FROM (SELECT *, CASE WHEN l_orderkey % 10 <> 0 THEN l_returnflag END AS flag FROM lineitem) WHERE flag IS NOT NULL
    GROUP BY flag, l_linestatus""",
)
def dup_aggregate_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.when(F.col("l_orderkey") % 10 != 0, F.col("l_returnflag")).alias("flag")
    items = table(spark, sf_dir, "lineitem").select(flag, "l_linestatus", "l_extendedprice")
    merged = merge_duplicate_features(items, "l_extendedprice", drop_null_keys=True, size_column="group_size")
    return rounded(merged, 4, "l_extendedprice")


@query(
    "q_reduction_report",
    """SELECT CAST(sum(n) AS BIGINT) AS rows_before, count(*) AS rows_after, CAST(sum(n) - count(*) AS BIGINT) AS rows_saved,
    round(avg(n), 6) AS mean_group_size
    FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_returnflag, l_linestatus, l_quantity)""",
)
def reduction(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity", "l_extendedprice")
    merged = merge_duplicate_features(items, "l_extendedprice", size_column="group_size")
    return rounded(reduction_report(merged, "group_size"), 6, "mean_group_size")


@query(
    "q_distinct_combinations",
    "SELECT count(*) AS combinations FROM (SELECT DISTINCT l_returnflag, l_linestatus, l_quantity, l_discount FROM lineitem)",
)
def combinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_combinations(
        table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus", "l_quantity", "l_discount"]
    )


@query(
    "q_group_size_join",
    """SELECT c_nationkey, c_mktsegment, round(avg(c_acctbal), 4) AS mean_balance, count(*) AS size
    FROM customer GROUP BY c_nationkey, c_mktsegment""",
)
def group_size_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = table(spark, sf_dir, "customer").groupBy("c_nationkey", "c_mktsegment")
    means = groups.agg(F.round(F.avg("c_acctbal"), 4).alias("mean_balance"))
    return attach_group_sizes(means, groups.agg(F.count("*").alias("size")), ["c_nationkey", "c_mktsegment"])


# Coercing and imputing


def text_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part sizes and prices as text, with unreadable cells."""
    key = F.col("p_partkey")
    size = F.when(key % 7 == 0, "n/a").otherwise(F.col("p_size").cast("string"))
    price = F.when(key % 10 == 0, None).otherwise(F.round("p_retailprice", 2).cast("string"))
    return table(spark, sf_dir, "part").select("p_partkey", size.alias("size"), price.alias("price"), "p_name")


@query(
    "q_coerce_numeric",
    """SELECT p_partkey, CASE WHEN p_partkey % 7 <> 0 THEN CAST(p_size AS DOUBLE) END AS size,
    CASE WHEN p_partkey % 10 <> 0 THEN round(p_retailprice, 2) END AS price, CAST(NULL AS DOUBLE) AS p_name FROM part""",
)
def coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coerce_numeric(text_parts(spark, sf_dir), ["size", "price", "p_name"])


@query(
    "q_prepare_features",
    """WITH p AS (SELECT p_partkey, CASE WHEN p_partkey % 7 <> 0 THEN CAST(p_size AS DOUBLE) END AS size,
      CASE WHEN p_partkey % 10 <> 0 THEN round(p_retailprice, 2) END AS price FROM part)
    SELECT p_partkey, coalesce(size, (SELECT median(size) FROM p)) AS size,
      round(coalesce(price, (SELECT median(price) FROM p)), 6) AS price FROM p""",
)
def prepared_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(prepare_features(text_parts(spark, sf_dir).drop("p_name"), ["size", "price"]), 6, "price")


def gappy_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        k.alias("row_id"),
        F.when(k % 10 != 0, F.col("o_totalprice")).alias("price"),
        F.when(k % 3 != 0, F.col("o_custkey") % 40).alias("segment"),
        F.when(k % 10 != 1, F.col("o_orderpriority")).alias("priority"),
        F.lit(None).cast("string").alias("remark"),
    )


GAPPY_SQL = """WITH g AS (SELECT o_orderkey AS row_id, CASE WHEN o_orderkey % 10 <> 0 THEN o_totalprice END AS price,
  CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey % 40 END AS segment,
  CASE WHEN o_orderkey % 10 <> 1 THEN o_orderpriority END AS priority FROM orders)"""


@query(
    "q_impute_median",
    f"""{GAPPY_SQL} SELECT row_id, round(coalesce(price, (SELECT median(price) FROM g)), 6) AS price,
    CAST(coalesce(segment, (SELECT median(segment) FROM g)) AS DOUBLE) AS segment FROM g""",
)
def impute_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = gappy_orders(spark, sf_dir)
    filled = fill_missing(orders, fit_medians(orders, exclude=["row_id"]))
    return rounded(filled.select("row_id", "price", "segment"), 6, "price")


@query(
    "q_impute_mode",
    f"""{GAPPY_SQL} SELECT row_id, coalesce(priority, (SELECT priority FROM g WHERE priority IS NOT NULL GROUP BY priority
    ORDER BY count(*) DESC, priority LIMIT 1)) AS priority, 'Не указано' AS remark FROM g""",
)
def impute_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = gappy_orders(spark, sf_dir)
    return fill_missing(orders, fit_modes(orders, v.NOT_STATED)).select("row_id", "priority", "remark")


NEARLY_UNIQUE_SQL = """WITH k AS (SELECT o_orderkey AS row_id, CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 50 = 3 THEN 'common'
  WHEN o_orderkey % 50 = 4 THEN 'as common' ELSE 'order ' || o_orderkey END AS remark, 'order ' || o_orderkey AS key FROM orders)"""


@query(
    "q_impute_mode_nearly_unique",
    f"""{NEARLY_UNIQUE_SQL} SELECT row_id, coalesce(remark, (SELECT remark FROM k WHERE remark IS NOT NULL GROUP BY remark
    ORDER BY count(*) DESC, remark LIMIT 1)) AS remark, (SELECT min(key) FROM k) AS smallest_key FROM k""",
)
def impute_mode_nearly_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most values of ``remark`` occur once: its mode comes from a summary. No value of ``key`` stands out: the smallest is its mode."""
    k = F.col("o_orderkey")
    key = F.concat(F.lit("order "), k.cast("string"))
    remark = F.when(k % 7 == 0, None).when(k % 50 == 3, "common").when(k % 50 == 4, "as common").otherwise(key)
    orders = table(spark, sf_dir, "orders").select(k.alias("row_id"), remark.alias("remark"), key.alias("key"))
    fills = fit_modes(orders, v.NOT_STATED)
    return fill_missing(orders, {"remark": fills["remark"]}).select("row_id", "remark", F.lit(fills["key"]).alias("smallest_key"))


# Encoding


@query(
    "q_high_cardinality_drop",
    """WITH d AS (SELECT 'p_name' AS feature, count(DISTINCT p_name) AS distinct_values FROM part
      UNION ALL SELECT 'p_brand', count(DISTINCT p_brand) FROM part UNION ALL SELECT 'p_type', count(DISTINCT p_type) FROM part)
    SELECT feature, distinct_values, distinct_values > 50 AS dropped FROM d""",
)
def high_cardinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["p_name", "p_brand", "p_type"]
    parts = table(spark, sf_dir, "part").select(*columns)
    dropped = fit_encoder(parts, max_distinct=50).dropped
    return distinct_counts(parts, columns).withColumn("dropped", F.col("feature").isin(dropped))


@query(
    "q_binary_encode",
    """WITH f AS (SELECT l_linestatus, min((l_orderkey, l_partkey, l_suppkey, l_linenumber)) AS seen FROM lineitem GROUP BY 1),
    first AS (SELECT l_linestatus FROM f ORDER BY seen LIMIT 1)
    SELECT CAST(l_linestatus <> (SELECT l_linestatus FROM first) AS DOUBLE) AS l_linestatus, count(*) AS rows,
      round(sum(l_quantity), 4) AS quantity FROM lineitem GROUP BY 1""",
)
def binary_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    items = table(spark, sf_dir, "lineitem").select(*order, "l_linestatus", "l_quantity")
    encoded = apply_binary(items, fit_encoder(items, order_by=order).binary)
    return encoded.groupBy("l_linestatus").agg(
        F.count("*").alias("rows"), F.round(F.sum("l_quantity"), 4).alias("quantity")
    )


@query(
    "q_onehot",
    """SELECT c_custkey, c_mktsegment = 'BUILDING' AS "c_mktsegment_BUILDING", c_mktsegment = 'FURNITURE' AS "c_mktsegment_FURNITURE",
    c_mktsegment = 'HOUSEHOLD' AS "c_mktsegment_HOUSEHOLD", c_mktsegment = 'MACHINERY' AS "c_mktsegment_MACHINERY" FROM customer""",
)
def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return apply_one_hot(customers, fit_encoder(customers).one_hot)


@query(
    "q_onehot_clash",
    """SELECT c_custkey, c_nationkey AS "kind_b", CASE c_custkey % 4 WHEN 1 THEN true ELSE false END AS "kind_B_2",
    c_custkey % 4 = 2 AS "kind_a_2", c_custkey % 4 = 3 AS "kind_b_3" FROM customer""",
)
def one_hot_clash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Categories that differ in case only, beside a column that has the name of one."""
    kinds = F.element_at(F.array(*map(F.lit, ["A", "B", "a", "b"])), (F.col("c_custkey") % 4 + 1).cast("int"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("kind_b"), F.lit(1).alias("kind_A"), kinds.alias("kind"))
    encoder = fit_encoder(customers, exclude=["c_custkey"])
    return encoder.apply(customers).drop("kind_A")


@query(
    "q_salted_map",
    """SELECT l_orderkey, l_linenumber, coalesce(CASE WHEN l_suppkey % 3 <> 0 THEN s_acctbal END, -1.0) AS l_suppkey
    FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey""",
)
def salted_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The way taken by lookups too large to broadcast."""
    suppliers = table(spark, sf_dir, "supplier").where("s_suppkey % 3 <> 0").select(F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("value"))
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    return map_values(items, "l_suppkey", suppliers, F.lit(-1.0), lookup_bytes=1 << 40)


WIDE = [f"x{i}" for i in range(12)]


def wide_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve columns; x0 is null in all early rows and lies near 1.7e12 after them."""
    late = F.when(F.col("o_orderkey") >= 1000, 1.7e12 + F.col("o_custkey"))
    others = [(F.col("o_totalprice") * (i + 1) + F.col("o_custkey") * (i % 3)).alias(f"x{i}") for i in range(1, 12)]
    return table(spark, sf_dir, "orders").select("o_orderkey", late.alias("x0"), *others, F.col("o_custkey").cast("double").alias("y"))


WIDE_SQL = f"""WITH w AS (SELECT o_orderkey, CASE WHEN o_orderkey >= 1000 THEN 1.7e12 + o_custkey END AS x0,
  {', '.join(f'o_totalprice * {i + 1} + o_custkey * {i % 3} AS x{i}' for i in range(1, 12))}, o_custkey::DOUBLE AS y FROM orders)"""


@query(
    "q_standard_scale_wide",
    f"""{WIDE_SQL}, s AS (SELECT {', '.join(f'avg({x} - CASE WHEN {i} = 0 THEN 1.7e12 ELSE 0 END) + CASE WHEN {i} = 0 THEN 1.7e12 ELSE 0 END AS m{i}, stddev_pop({x} - CASE WHEN {i} = 0 THEN 1.7e12 ELSE 0 END) AS d{i}' for i, x in enumerate(WIDE))} FROM w)
    SELECT o_orderkey, {', '.join(f'round(({x} - m{i}) / d{i}, 3) + 0.0 AS {x}' for i, x in enumerate(WIDE))} FROM w, s""",
)
def standard_scale_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = wide_orders(spark, sf_dir).drop("y")
    return apply_scaling(orders, fit_standard(orders, WIDE)).select("o_orderkey", *[(F.round(x, 3) + 0.0).alias(x) for x in WIDE])


@query(
    "q_corr_wide",
    f"""{WIDE_SQL}, z AS (SELECT x0 - 1.7e12 AS x0, {', '.join(WIDE[1:])} FROM w)
    SELECT feature, other, round(correlation, 6) AS correlation, round(abs(correlation), 6) AS abs_correlation FROM (
    {' UNION ALL '.join(f"SELECT '{a}' AS feature, '{b}' AS other, corr({a}, {b}) AS correlation FROM z" for i, a in enumerate(WIDE) for b in WIDE[i + 1 :])})""",
)
def corr_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix = correlation_array(wide_orders(spark, sf_dir), WIDE)
    return rounded(correlation_table(spark, WIDE, matrix), 6, "correlation", "abs_correlation")


BASES, MANY = 25, 500


def many_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """500 columns, each a linear form of one of 25; two neighbouring forms are close."""
    item = {b: F.col("l_quantity") * (1 + b % 2) + F.pmod(F.col("l_partkey") * (1 + b // 2), F.lit(101)) * (b // 2) for b in range(BASES)}
    columns = [((item[c % BASES] * (1 + c // BASES)) * (-1 if c % 3 == 0 else 1) + c).alias(f"x{c}") for c in range(MANY)]
    return table(spark, sf_dir, "lineitem").select(*columns)


@query(
    "q_corr_500_columns",
    f"""WITH b AS (SELECT {', '.join(f'l_quantity * {1 + b % 2} + (l_partkey * {1 + b // 2}) % 101 * {b // 2} AS b{b}' for b in range(BASES))} FROM lineitem),
    r AS ({' UNION ALL '.join(f"SELECT {a} AS a, {b} AS b, corr(b{a}, b{b}) AS r FROM b" for a in range(BASES) for b in range(a, BASES))}),
    both_ways AS (SELECT a, b, r FROM r UNION ALL SELECT b, a, r FROM r WHERE a <> b), c AS (SELECT range AS i FROM range({MANY}))
    SELECT 'x' || x.i AS feature, 'x' || y.i AS other, round(r * CASE WHEN (x.i % 3 = 0) <> (y.i % 3 = 0) THEN -1 ELSE 1 END, 6) AS correlation
    FROM c x JOIN c y ON x.i < y.i JOIN both_ways ON a = x.i % {BASES} AND b = y.i % {BASES} WHERE abs(r) > 0.99""",
)
def corr_500_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strong pairs of 500 columns, by blocks of columns."""
    pairs = pair_correlations(many_columns(spark, sf_dir), [f"x{c}" for c in range(MANY)])
    return rounded(strong_pairs(pairs, 0.99).select("feature", "other", "correlation"), 6, "correlation")


@query(
    "q_target_topk_wide",
    f"""{WIDE_SQL}, z AS (SELECT x0 - 1.7e12 AS x0, {', '.join(WIDE[1:])}, y FROM w),
    r AS ({' UNION ALL '.join(f"SELECT {i} AS position, '{x}' AS feature, corr({x}, y) AS correlation FROM z" for i, x in enumerate(WIDE))})
    SELECT feature, round(correlation, 6) AS correlation, CASE WHEN correlation > 0 THEN 'up' ELSE 'down' END AS direction
    FROM r WHERE correlation IS NOT NULL AND NOT isnan(correlation) ORDER BY round(abs(correlation), 9) DESC, position DESC LIMIT 1""",
)
def target_topk_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The column that only late rows have is the strongest one."""
    top = strongest(target_correlations(wide_orders(spark, sf_dir), WIDE, "y"), 1)
    return rounded(top.select("feature", "correlation", "direction"), 6, "correlation")


def national_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the customer's nation name, null for every eleventh order."""
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    orders = table(spark, sf_dir, "orders").join(customer, "o_custkey").join(nation, "c_nationkey")
    name = F.when(F.col("o_orderkey") % 11 != 0, F.col("n_name")).alias("nation")
    half = F.when(F.col("o_orderkey") % 2 == 0, "even").otherwise("odd").alias("half")
    text_key = F.col("o_orderkey").cast("string").alias("text_key")
    return orders.select(
        F.col("o_orderkey").alias("row_id"), text_key, half, "o_orderstatus", name, F.col("o_totalprice").alias("price")
    )


NATIONAL_SQL = """WITH n AS (SELECT o_orderkey AS row_id, o_orderstatus, o_totalprice AS price,
  CASE WHEN o_orderkey % 11 <> 0 THEN n_name END AS nation FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey), m AS (SELECT nation, avg(price) AS mean FROM n WHERE nation IS NOT NULL GROUP BY nation)"""


@query(
    "q_target_encode",
    f"""{NATIONAL_SQL} SELECT row_id, round(coalesce(mean, (SELECT avg(price) FROM n)), 4) AS nation
    FROM n LEFT JOIN m ON n.nation = m.nation""",
)
def target_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = national_orders(spark, sf_dir).select("row_id", "nation", "price")
    encoder = fit_encoder(orders, "price", ["row_id"])
    return rounded(encoder.apply(orders).select("row_id", "nation"), 4, "nation")


@query(
    "q_encode_all",
    f"""{NATIONAL_SQL}
    SELECT row_id, CAST(row_id % 2 AS DOUBLE) AS half, round(coalesce(mean, (SELECT avg(price) FROM n)), 4) AS nation,
      o_orderstatus = 'O' AS "o_orderstatus_O", o_orderstatus = 'P' AS "o_orderstatus_P", price
    FROM n LEFT JOIN m ON n.nation = m.nation""",
)
def encode_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = national_orders(spark, sf_dir)
    # the text key has as many values as rows, so it goes; the limit is set for the smallest test table
    encoder = fit_encoder(orders, "price", ["row_id"], max_distinct=500, max_one_hot=v.MAX_ONE_HOT)
    return rounded(encoder.apply(orders), 4, "nation")


# Correlations

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def priced_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line item measures, a discounted price that nearly repeats the price, a gap column and a constant."""
    return table(spark, sf_dir, "lineitem").select(
        *MEASURES,
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"),
        F.when(F.col("l_linenumber") != 3, F.col("l_tax") * F.col("l_quantity")).alias("tax_part"),
        F.lit(1.0).alias("constant"),
    )


PRICED_COLUMNS = [*MEASURES, "revenue", "tax_part", "constant"]
PRICED_SQL = """WITH i AS (SELECT l_quantity, l_extendedprice, l_discount, l_tax, l_extendedprice * (1 - l_discount) AS revenue,
  CASE WHEN l_linenumber <> 3 THEN l_tax * l_quantity END AS tax_part, 1.0::DOUBLE AS "constant" FROM lineitem)"""


def _pairs_sql() -> str:
    pairs = []
    for i, a in enumerate(PRICED_COLUMNS):
        for b in PRICED_COLUMNS[i + 1 :]:
            value = "CAST(NULL AS DOUBLE)" if b == "constant" else f"(SELECT round(corr({a}, {b}), 6) FROM i)"
            pairs.append(f"SELECT '{a}' AS feature, '{b}' AS other, {value} AS correlation")
    return f"{PRICED_SQL}, pairs AS ({' UNION ALL '.join(pairs)})"


@query("q_corr_matrix", f"{_pairs_sql()} SELECT feature, other, correlation, abs(correlation) AS abs_correlation FROM pairs")
def corr_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix = correlation_array(priced_items(spark, sf_dir), PRICED_COLUMNS)
    return rounded(correlation_table(spark, PRICED_COLUMNS, matrix), 6, "correlation", "abs_correlation")


@query(
    "q_near_duplicate_pairs",
    f"{_pairs_sql()} SELECT count(*) AS near_duplicate_pairs FROM pairs WHERE abs(correlation) > 0.99",
)
def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix = correlation_array(priced_items(spark, sf_dir), PRICED_COLUMNS)
    return near_duplicate_pairs(correlation_table(spark, PRICED_COLUMNS, matrix), 0.99)


@query(
    "q_collinear_drop",
    f"""{_pairs_sql()}, both_ways AS (SELECT feature, correlation FROM pairs UNION ALL SELECT other, correlation FROM pairs
      UNION ALL SELECT DISTINCT other, 1.0 FROM pairs WHERE other <> 'constant' UNION ALL SELECT 'l_quantity', 1.0),
    strength AS (SELECT feature, avg(abs(correlation)) AS mean FROM both_ways GROUP BY feature)
    SELECT p.feature, p.other, CASE WHEN a.mean > b.mean THEN p.feature ELSE p.other END AS dropped
    FROM pairs p JOIN strength a ON p.feature = a.feature JOIN strength b ON p.other = b.feature
    WHERE abs(p.correlation) > 0.95""",
)
def collinear_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix = correlation_array(priced_items(spark, sf_dir), PRICED_COLUMNS)
    dropped = collinear_columns(PRICED_COLUMNS, matrix, 0.95)
    strong = correlation_table(spark, PRICED_COLUMNS, matrix).filter(F.col("abs_correlation") > 0.95)
    gone = F.when(F.col("feature").isin(dropped), F.col("feature")).when(F.col("other").isin(dropped), F.col("other"))
    return strong.select("feature", "other", gone.alias("dropped"))


@query(
    "q_target_corr_topk",
    f"""{PRICED_SQL}, c AS (SELECT 0 AS position, 'l_quantity' AS feature, corr(l_quantity, revenue) AS c FROM i UNION ALL
      SELECT 1, 'l_extendedprice', corr(l_extendedprice, revenue) FROM i UNION ALL
      SELECT 2, 'l_discount', corr(l_discount, revenue) FROM i UNION ALL SELECT 3, 'l_tax', corr(l_tax, revenue) FROM i UNION ALL
      SELECT 4, 'tax_part', corr(tax_part, revenue) FROM i)
    SELECT position, feature, round(c, 6) AS correlation, round(abs(c), 6) AS abs_correlation,
      CASE WHEN c > 0 THEN 'up' ELSE 'down' END AS direction FROM c ORDER BY abs(c) DESC, position DESC LIMIT 3""",
)
def target_corr_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = [*MEASURES, "tax_part", "constant"]
    top = strongest(target_correlations(priced_items(spark, sf_dir), features, "revenue"), 3)
    return rounded(top, 6, "correlation", "abs_correlation")


# Outliers and scaling

IQR_SQL = """WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events),
b AS (SELECT q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high FROM q)"""
Z_SQL = """WITH b AS (SELECT avg(value) - 3 * stddev_samp(value) AS low, avg(value) + 3 * stddev_samp(value) AS high FROM events)"""


def event_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "value")


@query(
    "q_outlier_counts",
    f"""{IQR_SQL} SELECT 'value' AS feature, count(*) FILTER (value < low OR value > high) AS outliers,
    round(count(*) FILTER (value < low OR value > high) / count(*) * 100, 6) AS percent FROM events, b""",
)
def outlier_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = event_values(spark, sf_dir)
    return rounded(count_outliers(events, fit_bounds(events, "iqr", 1.5, ["value"])), 6, "percent")


@query("q_winsorize_iqr", f"{IQR_SQL} SELECT event_id, round(least(greatest(value, low), high), 6) AS value FROM events, b")
def winsorize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(treat_outliers(event_values(spark, sf_dir), "iqr", "winsorize", 1.5, ["value"]), 6, "value")


@query("q_clip_zscore", f"{Z_SQL} SELECT event_id, round(least(greatest(value, low), high), 6) AS value FROM events, b")
def clip_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(treat_outliers(event_values(spark, sf_dir), "zscore", "clip", 3.0, ["value"]), 6, "value")


@query("q_remove_outliers", f"{IQR_SQL} SELECT event_id, value FROM events, b WHERE value >= low AND value <= high")
def remove_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return treat_outliers(event_values(spark, sf_dir), "iqr", "remove", 1.5, ["value"])


@query(
    "q_robust_scale",
    """WITH q AS (SELECT quantile_cont(p_size, 0.25) AS a1, median(p_size) AS a2, quantile_cont(p_size, 0.75) AS a3,
      quantile_cont(p_retailprice, 0.25) AS b1, median(p_retailprice) AS b2, quantile_cont(p_retailprice, 0.75) AS b3 FROM part)
    SELECT p_partkey, round((p_size - a2) / (a3 - a1), 6) AS p_size, round((p_retailprice - b2) / (b3 - b1), 6) AS p_retailprice
    FROM part, q""",
)
def robust_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    scaled = apply_scaling(parts, fit_robust(parts, ["p_size", "p_retailprice"]))
    return rounded(scaled, 6, "p_size", "p_retailprice")


@query(
    "q_standard_scale",
    """SELECT c_custkey, round((c_acctbal - (SELECT avg(c_acctbal) FROM customer)) / (SELECT stddev_pop(c_acctbal) FROM customer), 6)
    AS c_acctbal FROM customer""",
)
def standard_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return rounded(apply_scaling(customers, fit_standard(customers, ["c_acctbal"])), 6, "c_acctbal")


@query(
    "q_normalize",
    """WITH z AS (SELECT o_orderkey, CASE WHEN o_orderkey % 10 <> 0 THEN o_totalprice ELSE 0.0 END AS x FROM orders),
    r AS (SELECT o_orderkey, (x - (SELECT median(x) FROM z)) / (SELECT quantile_cont(x, 0.75) - quantile_cont(x, 0.25) FROM z) AS y FROM z)
    SELECT o_orderkey AS row_id, round((y - (SELECT avg(y) FROM r)) / (SELECT stddev_pop(y) FROM r), 6) AS price,
    o_orderkey % 2 = 0 AS even FROM r""",
)
def normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = gappy_orders(spark, sf_dir).select("row_id", "price", (F.col("row_id") % 2 == 0).alias("even"))
    columns, steps = fit_normalizer(orders, robust=True, standard=True, exclude=["row_id"])
    return rounded(normalize(orders, columns, steps), 6, "price")


# Target


def shifted_balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select("s_suppkey", (F.col("s_acctbal") - 2000).alias("y"))


SHIFTED_SQL = "WITH t AS (SELECT s_suppkey, s_acctbal - 2000 AS y FROM supplier)"


@query(
    "q_target_prepare",
    f"""{SHIFTED_SQL} SELECT s_suppkey, round(ln(1 + CASE WHEN y <= 0 THEN (SELECT min(y) FROM t WHERE y > 0) ELSE y END), 6) AS y
    FROM t""",
)
def target_prepare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(prepare_target(shifted_balances(spark, sf_dir), "y"), 6, "y")


@query(
    "q_target_profile",
    f"""{SHIFTED_SQL} SELECT round(min(y) FILTER (y > 0), 6) AS min_positive, count(*) FILTER (y <= 0) AS non_positive,
    round(count(*) FILTER (y <= 0) / count(*), 6) AS non_positive_share FROM t""",
)
def target_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(target_profile(shifted_balances(spark, sf_dir), "y"), 6, "min_positive", "non_positive_share")


@query(
    "q_quality_check",
    """WITH x AS (SELECT CASE WHEN event_id % 10 <> 0 THEN value END AS a, CAST(user_id AS DOUBLE) AS b, ln(1 + value) AS y FROM events),
    cells AS (SELECT a AS c FROM x WHERE a IS NOT NULL UNION ALL SELECT b FROM x),
    m AS (SELECT avg(y) AS mean, stddev_pop(y) AS std, count(*) AS n FROM x),
    skew AS (SELECT avg(((y - mean) / std) ** 3) AS s FROM x, m)
    SELECT (SELECT count(*) FROM x) AS rows, (SELECT count(*) FROM x WHERE a IS NULL) AS x_missing, 0 AS y_missing, 0 AS x_infinite,
      0 AS y_infinite, round(min(c), 4) AS x_min, round(max(c), 4) AS x_max, round(avg(c), 4) AS x_mean, round(stddev_pop(c), 4) AS x_std,
      (SELECT round(mean, 4) FROM m) AS y_mean, (SELECT round(std, 4) FROM m) AS y_std, (SELECT round(min(y), 4) FROM x) AS y_min,
      (SELECT round(max(y), 4) FROM x) AS y_max, (SELECT round(s, 4) FROM skew) AS y_skewness,
      (SELECT round(s * sqrt(n * (n - 1)) / (n - 2), 4) FROM skew, m) AS y_skewness_corrected,
      (SELECT abs(mean) > 1 OR std > 10 FROM m) AS target_unusual FROM cells""",
)
def quality_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = table(spark, sf_dir, "events").select(
        F.when(F.col("event_id") % 10 != 0, F.col("value")).alias("a"),
        F.col("user_id").cast("double").alias("b"),
        F.log1p("value").alias("y"),
    )
    report = quality_report(cells, ["a", "b"], "y")
    return rounded(report, 4, *[name for name, kind in report.dtypes if kind == "double"])


@query(
    "q_target_sample",
    """SELECT round(min(v), 4) AS "min", round(max(v), 4) AS "max" FROM (SELECT value AS v FROM events ORDER BY event_id LIMIT 100)""",
)
def target_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = event_values(spark, sf_dir).withColumn("y", F.log1p("value"))
    return rounded(back_transformed_sample(logs, "y", "event_id"), 4, "min", "max")


# Splits


def hash_sql(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)"


@query(
    "q_split",
    f"SELECT o_orderkey AS row_id, {hash_sql('CAST(o_orderkey AS VARCHAR)')} % 100 < 20 AS is_test FROM orders",
)
def split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_test_flag(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("row_id")), "row_id")


@query(
    "q_folds",
    f"""SELECT o_orderkey AS row_id, CAST({hash_sql("'fold:' || CAST(o_orderkey AS VARCHAR)")} % 5 AS INTEGER) AS fold FROM orders""",
)
def folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_fold(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("row_id")), "row_id")


@query(
    "q_stratified_split_many",
    """SELECT row_id, label, row_number() OVER (PARTITION BY label ORDER BY md5(CAST(row_id AS VARCHAR))) <=
      floor(0.3 * count(*) OVER (PARTITION BY label) + 1e-9) AS is_test
    FROM (SELECT o_orderkey AS row_id, CASE WHEN o_orderkey % 3 = 0 THEN -1 ELSE o_custkey END AS label FROM orders)""",
)
def stratified_split_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A class per customer, and one with a third of all rows; cuts are searched by prefix."""
    label = F.when(F.col("o_orderkey") % 3 == 0, -1).otherwise(F.col("o_custkey"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("row_id"), label.alias("label"))
    return with_stratified_test_flag(orders, "row_id", "label", leaf_rows=50)


@query(
    "q_stratified_split",
    """SELECT row_id, status, row_number() OVER (PARTITION BY status ORDER BY md5(CAST(row_id AS VARCHAR))) <=
      floor(0.3 * count(*) OVER (PARTITION BY status)) AS is_test
    FROM (SELECT o_orderkey AS row_id, o_orderstatus AS status FROM orders)""",
)
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("row_id"), F.col("o_orderstatus").alias("status")
    )
    return with_stratified_test_flag(orders, "row_id", "status")
