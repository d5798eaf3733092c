"""Queries over validation, projections and reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.checks.binding import FLAT_CTE, RAW_CTE, VALID_CTE, order_objects, order_records, raw_orders
from cairn.checks.registry import query, table
from cairn.contracts import REQUIRED_FIELDS
from cairn.functions.paths import is_record_file, rewrite_zone
from cairn.functions.values import canonical_json, run_stamp
from cairn.operators.reports import group_report, region_report as regions
from cairn.operators.reports import region_sum as sums, region_sum_count as sums_counts
from cairn.operators.reports import run_report_sql, top_k_report as top_k
from cairn.operators.rules import check, contract_rules, quality_metrics, rules_from_table, validate, weak_rules
from cairn.operators.transforms import curate as curated, enrich, flatten as flat, local_projection as local
from cairn.operators.transforms import with_density
from cairn.plans.medallion import gate
from cairn.sources import observed
from cairn.sources.records import parse_records
from cairn.workspace import scratch_path

RUN_DATE = dt.date(2024, 1, 31)


def valid_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate(raw_orders(spark, sf_dir), contract_rules())[0]


def curated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curated(flat(valid_orders(spark, sf_dir)), RUN_DATE)


@query(
    f"""WITH {VALID_CTE} SELECT common AS country_name, official AS official_name, region, subregion, population, area, capital, currencies FROM valid"""
)
def validate_valid(spark, sf_dir):
    names = F.col("name.common").alias("country_name"), F.col("name.official").alias("official_name")
    numbers = F.col("population").cast("bigint"), F.col("area").cast("double")
    nested = F.to_json("capital").alias("capital"), canonical_json(F.col("currencies")).alias("currencies")
    return valid_orders(spark, sf_dir).select(*names, "region", "subregion", *numbers, *nested)


@query(
    f"""WITH {RAW_CTE}, judged AS (
      SELECT *, concat_ws(',', CASE WHEN NOT has_name THEN 'name_required' END,
        CASE WHEN population IS NULL THEN 'population_required' END,
        CASE WHEN region IS NULL THEN 'region_required' END,
        CASE WHEN population IS NULL OR population <= 0 THEN 'population_min' END) AS reasons FROM raw)
    SELECT common AS country_name, region, population, reasons FROM judged WHERE reasons <> ''"""
)
def validate_rejected_reasons(spark, sf_dir):
    rejected = validate(raw_orders(spark, sf_dir), contract_rules())[1]
    return rejected.select(
        F.col("name.common").alias("country_name"),
        "region",
        F.col("population").cast("bigint"),
        F.array_join("reasons", ",").alias("reasons"),
    )


@query("SELECT c_custkey, c_mktsegment, c_acctbal FROM customer WHERE c_acctbal > 0")
def validate_weak(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").withColumn("population", F.col("c_acctbal"))
    return validate(customers, weak_rules())[0].select("c_custkey", "c_mktsegment", "c_acctbal")


@query("SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 2500 AND c_name IS NOT NULL")
def validate_configured(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").withColumn("population", F.col("c_acctbal"))
    rules = contract_rules(required=("c_name",), population_min=2500)
    return validate(customers, rules)[0].select("c_custkey", "c_acctbal")


RULE_ROWS = """
    SELECT 1 AS position, 'balance' AS name, 'c_acctbal' AS field, 'minimum' AS kind, CAST(CAST(floor(max(c_acctbal) / 4) AS BIGINT) AS STRING) AS bound, false AS allow_nulls, 'customer' AS source FROM customer
    UNION ALL SELECT 2, NULL, 'c_mktsegment', 'member', '["BUILDING","MACHINERY","AUTOMOBILE"]', NULL, 'customer'
    UNION ALL SELECT 3, 'nation', 'c_nationkey', 'maximum', CAST(max(c_nationkey) - 2 AS STRING), false, 'customer' FROM customer
    UNION ALL SELECT 1, 'official', 'name.official', 'required', NULL, false, 'orders'
    UNION ALL SELECT 2, 'level', 'codes.level', 'minimum', '2', false, 'orders'
    UNION ALL SELECT 3, 'day', 'codes.`of.day`', 'pattern', '^(1|4)', true, 'orders'
    UNION ALL SELECT 4, 'unit', 'currencies.AAB.parts.unit', 'member', '["cent"]', true, 'orders'
    UNION ALL SELECT 5, 'region', 'region', 'pattern', '^[1-3]', true, 'orders'"""


@query(
    f"""WITH {RAW_CTE}, customers AS (
      SELECT 'customer' AS source, c_custkey AS k, concat_ws(',',
        CASE WHEN NOT c_acctbal > (SELECT floor(max(c_acctbal) / 4) FROM customer) THEN 'balance' END,
        CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE') THEN 'c_mktsegment_member' END,
        CASE WHEN NOT c_nationkey < (SELECT max(c_nationkey) - 2 FROM customer) THEN 'nation' END) AS reasons FROM customer),
    records AS (
      SELECT 'orders' AS source, k, concat_ws(',', CASE WHEN official IS NULL THEN 'official' END,
        CASE WHEN NOT k % 9 > 2 THEN 'level' END, CASE WHEN k % 6 <> 0 AND left(CAST(k AS VARCHAR), 1) NOT IN ('1', '4') THEN 'day' END,
        CASE WHEN left(region, 1) NOT IN ('1', '2', '3') OR region = '' THEN 'region' END) AS reasons FROM raw)
    SELECT source, k, CASE WHEN reasons = '' THEN 'valid' ELSE 'rejected' END AS verdict, reasons FROM (SELECT * FROM customers UNION ALL SELECT * FROM records)"""
)
def validate_by_table(spark, sf_dir):
    """Rules stored as rows, their bounds taken from the data, over a plain table and over records with members beyond the contract."""
    stored = scratch_path(spark, "rules")
    spark.sql(RULE_ROWS.replace("FROM customer", "FROM {customer}"), customer=table(spark, sf_dir, "customer")).write.partitionBy("source").parquet(stored)
    rules = spark.read.parquet(stored)
    customers = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "k")
    valid, rejected = validate(customers, rules_from_table(rules.where("source = 'customer'")))
    judged = valid.select(F.lit("customer").alias("source"), "k", F.lit("valid").alias("verdict"), F.lit("").alias("reasons"))
    judged = judged.unionByName(
        rejected.select(F.lit("customer").alias("source"), "k", F.lit("rejected").alias("verdict"), F.array_join("reasons", ",").alias("reasons"))
    )
    key = F.col("o_orderkey")
    day = F.when(key % 6 != 0, F.concat(F.lit(',"of.day":"'), key, F.lit('"'))).otherwise("")
    codes = F.concat(F.lit('{"codes":{"key":'), key, F.lit(',"level":'), key % 9, day, F.lit("},"), F.substr("record", F.lit(2)))
    records = order_objects(spark, sf_dir).select(codes.alias("record"), F.lit(None).cast("string").alias("file_path"))
    checked = check(parse_records(records), rules_from_table(rules.where("source = 'orders'")))
    k = F.get_json_object("record", "$.codes.key").cast("bigint").alias("k")
    return judged.unionByName(checked.select(F.lit("orders").alias("source"), k, "verdict", F.coalesce(F.array_join("reasons", ","), F.lit("")).alias("reasons")))


@query(
    f"""WITH {RAW_CTE}, n AS (SELECT count(*) AS n, count(*) FILTER (has_name AND region IS NOT NULL AND population > 0) AS good FROM raw)
    SELECT 'whole' AS landed, CAST(NULL AS VARCHAR) AS message, n AS n_records, good AS n_valid, good > 0 AS written FROM n
    UNION ALL SELECT 'no population', 'missing required columns: [''population'']', n, 0, false FROM n
    UNION ALL SELECT 'no name and no region', 'missing required columns: [''name'', ''region'']', n, 0, false FROM n
    UNION ALL SELECT 'none valid', 'no valid rows for the zone', n, 0, false FROM n
    UNION ALL SELECT 'none valid, skipped', NULL, n, 0, false FROM n"""
)
def gate_outcomes(spark, sf_dir):
    """What the gate says to records that lack a required field everywhere, or of which none is valid."""
    record, rules = F.col("record"), contract_rules()
    without = {
        "whole": (record, "fail"),
        "no population": (F.regexp_replace(record, '"population":', '"people":'), "fail"),
        "no name and no region": (F.regexp_replace(F.regexp_replace(record, '"name":\\{', '"title":{'), '"(name|region)":(null|")', '"x$1":$2'), "fail"),
        "none valid": (F.regexp_replace(record, '"population":[0-9.]+', '"population":0'), "fail"),
        "none valid, skipped": (F.regexp_replace(record, '"population":[0-9.]+', '"population":0'), "skip"),
    }
    outcomes = None
    for landed, (changed, on_empty) in without.items():
        records = order_records(spark, sf_dir).select(changed.alias("record"), F.lit(None).cast("string").alias("file_path"))
        checked, message, written, read = check(parse_records(records), rules), None, False, {}
        try:
            written = gate(checked, REQUIRED_FIELDS, rules, on_empty, "the zone", read)
        except ValueError as refusal:
            message = str(refusal)
        counts = checked.agg(F.count(F.lit(1)).alias("n_records"), F.count_if(F.col("verdict") == "valid").alias("n_valid"))
        if read:
            # the gate read all of them, and they are not parsed again to be counted
            counts = spark.range(1).select(F.lit(read["rows_in"]).cast("bigint").alias("n_records"), F.lit(read["rows_valid"]).cast("bigint").alias("n_valid"))
        outcome = counts.select(F.lit(landed).alias("landed"), F.lit(message).cast("string").alias("message"), "*", F.lit(written).alias("written"))
        outcomes = outcome if outcomes is None else outcomes.unionByName(outcome)
    return outcomes


@query(
    f"""WITH {RAW_CTE}
    SELECT 'name' AS field, count(*) FILTER (has_name OR k % 2 = 1) AS n_records, true AS present FROM raw
    UNION ALL SELECT 'region', count(*) FILTER (region IS NOT NULL OR k % 2 = 1), true FROM raw
    UNION ALL SELECT 'population', count(*) FILTER (population IS NOT NULL OR k % 2 = 1), true FROM raw
    UNION ALL SELECT 'continent', 0, false"""
)
def required_columns_gate(spark, sf_dir):
    return observed.field_presence(order_records(spark, sf_dir), ["name", "region", "population", "continent"])


@query(
    f"""WITH {RAW_CTE}
    SELECT 'rows_in' AS metric, count(*) AS n_rows FROM raw
    UNION ALL SELECT 'rows_valid', count(*) FILTER (has_name AND region IS NOT NULL AND coalesce(population, 0) > 0) FROM raw
    UNION ALL SELECT 'rows_rejected', count(*) FILTER (NOT (has_name AND region IS NOT NULL AND coalesce(population, 0) > 0)) FROM raw
    UNION ALL SELECT 'broken:name_required', count(*) FILTER (NOT has_name) FROM raw
    UNION ALL SELECT 'broken:population_required', count(*) FILTER (population IS NULL) FROM raw
    UNION ALL SELECT 'broken:region_required', count(*) FILTER (region IS NULL) FROM raw
    UNION ALL SELECT 'broken:population_min', count(*) FILTER (coalesce(population, 0) <= 0) FROM raw"""
)
def dq_metrics(spark, sf_dir):
    return quality_metrics(raw_orders(spark, sf_dir), contract_rules())


@query(f"WITH {FLAT_CTE} SELECT * FROM flat")
def flatten(spark, sf_dir):
    return flat(valid_orders(spark, sf_dir))


@query(f"WITH {FLAT_CTE} SELECT *, '2024-01-31' AS load_date FROM flat")
def curate(spark, sf_dir):
    return curated_orders(spark, sf_dir).withColumn("load_date", F.col("load_date").cast("string"))


@query(
    f"""WITH {FLAT_CTE}
    SELECT common AS country_name, official AS official_name, nullif(region, '') AS region, subregion, population, area,
      CASE WHEN k % 15 = 0 THEN NULL WHEN k % 3 = 0 THEN subregion ELSE '' END AS capital,
      CASE k % 4 WHEN 0 THEN 'ZZY' WHEN 1 THEN 'ORD' END AS currency_code,
      CASE WHEN k % 8 = 0 THEN 'Alpha ' || k WHEN k % 4 = 0 THEN 'Zeta' WHEN k % 4 = 1 THEN 'Order unit' END AS currency_name,
      round(population / nullif(area, 0), 2) AS population_density
    FROM valid"""
)
def enriched(spark, sf_dir):
    return enrich(valid_orders(spark, sf_dir))


@query(
    f"""WITH {RAW_CTE}
    SELECT common AS country_name, nullif(region, '') AS region, population,
      CASE WHEN k % 8 = 0 THEN 'Alpha ' || k WHEN k % 4 = 0 THEN 'Zeta' WHEN k % 4 = 1 THEN 'Order unit' END AS currency_name
    FROM raw WHERE population > 0"""
)
def local_projection(spark, sf_dir):
    return local(validate(raw_orders(spark, sf_dir), weak_rules())[0])


@query(
    f"""WITH {FLAT_CTE}
    SELECT country_name, population, area, round(population / nullif(area, 0), 2) AS population_density FROM flat"""
)
def density(spark, sf_dir):
    rows = with_density(flat(valid_orders(spark, sf_dir)))
    return rows.select("country_name", "population", "area", "population_density")


REGION_REPORT_ORACLE = f"""WITH {FLAT_CTE}
    SELECT region, CAST(sum(population) AS BIGINT) AS total_population, count(*) AS country_count,
           round(avg(population), 2) AS avg_population, max(population) AS max_population,
           min(population) AS min_population
    FROM flat GROUP BY region ORDER BY total_population DESC"""


@query(REGION_REPORT_ORACLE)
def region_report(spark, sf_dir):
    return regions(curated_orders(spark, sf_dir))


@query(
    """SELECT l_returnflag, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total_quantity, count(*) AS line_count,
         round(avg(CAST(l_quantity AS BIGINT)), 2) AS avg_quantity, max(CAST(l_quantity AS BIGINT)) AS max_quantity,
         min(CAST(l_quantity AS BIGINT)) AS min_quantity
    FROM lineitem GROUP BY l_returnflag"""
)
def lineitem_report(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", F.col("l_quantity").cast("bigint").alias("quantity"))
    return group_report(lines, "l_returnflag", "quantity", "line")


@query(f"WITH {FLAT_CTE} SELECT region, CAST(sum(population) AS BIGINT) AS total_population FROM flat GROUP BY region")
def region_sum(spark, sf_dir):
    return sums(curated_orders(spark, sf_dir))


@query(
    f"""WITH {FLAT_CTE} SELECT region, CAST(sum(population) AS BIGINT) AS total_population, count(*) AS countries
    FROM flat GROUP BY region ORDER BY 2 DESC"""
)
def region_sum_count(spark, sf_dir):
    return sums_counts(curated_orders(spark, sf_dir))


TOP_K_ORACLE = f"""WITH {FLAT_CTE}
    SELECT country_name, region, subregion, population, area, round(population / nullif(area, 0), 2) AS population_density
    FROM flat ORDER BY population DESC, country_name LIMIT 50"""


@query(TOP_K_ORACLE)
def top_k_report(spark, sf_dir):
    return top_k(curated_orders(spark, sf_dir))


@query(f"WITH {FLAT_CTE} SELECT subregion, count(*) AS n, max(area) AS max_area FROM flat GROUP BY subregion")
def report_sql(spark, sf_dir):
    text = "SELECT subregion, count(*) AS n, max(area) AS max_area FROM {curated} GROUP BY subregion"
    return run_report_sql(spark, text, curated_orders(spark, sf_dir))


@query(
    f"""WITH {RAW_CTE}
    SELECT 'name' AS field, count(*) FILTER (has_name OR k % 2 = 1) AS n_records FROM raw
    UNION ALL SELECT 'region', count(*) FILTER (region IS NOT NULL OR k % 2 = 1) FROM raw
    UNION ALL SELECT 'subregion', count(*) FROM raw
    UNION ALL SELECT 'population', count(*) FILTER (population IS NOT NULL OR k % 2 = 1) FROM raw
    UNION ALL SELECT 'area', count(*) FROM raw
    UNION ALL SELECT 'capital', count(*) FILTER (k % 15 = 0 OR k % 3 < 2 OR k % 2 = 1) FROM raw
    UNION ALL SELECT 'currencies', count(*) FILTER (k % 4 < 3 OR k % 2 = 1) FROM raw"""
)
def infer_columns(spark, sf_dir):
    return observed.observed_fields(order_records(spark, sf_dir))


# An even key leaves a field out where an odd one spells null.
@query(
    f"""WITH {RAW_CTE}, typed AS (
      SELECT k, unnest([
        {{'path': 'name', 'type': CASE WHEN has_name THEN 'OBJECT' ELSE 'VOID' END, 'n': 1}},
        {{'path': 'name.common', 'type': CASE WHEN has_name THEN 'STRING' END, 'n': 1}},
        {{'path': 'name.official', 'type': CASE WHEN official IS NOT NULL THEN 'STRING' WHEN has_name THEN 'VOID' END, 'n': 1}},
        {{'path': 'region', 'type': CASE WHEN region IS NULL THEN 'VOID' ELSE 'STRING' END, 'n': 1}},
        {{'path': 'subregion', 'type': 'STRING', 'n': 1}},
        {{'path': 'population', 'type': CASE WHEN population IS NULL THEN 'VOID' ELSE 'DECIMAL' END, 'n': 1}},
        {{'path': 'area', 'type': 'DECIMAL', 'n': 1}},
        {{'path': 'capital', 'type': CASE WHEN capital IS NOT NULL THEN 'ARRAY' ELSE 'VOID' END, 'n': 1}},
        {{'path': 'currencies', 'type': CASE WHEN k % 4 < 3 THEN 'OBJECT' ELSE 'VOID' END, 'n': 1}}]) AS spot FROM raw
      UNION ALL SELECT k, {{'path': 'capital[]', 'type': CASE WHEN k % 15 = 0 THEN 'NULL ELEMENT' ELSE 'STRING' END, 'n': CASE WHEN k % 15 = 0 THEN 1 ELSE 2 END}}
      FROM raw WHERE capital IS NOT NULL AND capital <> '[]')
    SELECT spot.path AS path, replace(spot.type, 'NULL ELEMENT', 'VOID') AS type, CAST(sum(spot.n) AS BIGINT) AS n_values FROM typed
    WHERE spot.type IS NOT NULL AND (spot.type <> 'VOID' OR k % 2 = 1) GROUP BY 1, 2"""
)
def infer_types(spark, sf_dir):
    return observed.observed_types(order_records(spark, sf_dir)).drop("ancestors")


def deep_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records four levels deep, with arrays of objects that hold arrays, and paths whose kinds differ."""
    return table(spark, sf_dir, "orders").selectExpr(
        """'{"key":' || o_orderkey || ',"a":{"b":{"c":{"d":' || CASE o_orderkey % 3 WHEN 0 THEN '7' WHEN 1 THEN '"x"' ELSE 'null' END || '}}},"lines":'
        || CASE WHEN o_orderkey % 2 = 0 THEN '[{"n":1,"tags":["x",' || o_orderkey || ']},{"n":2.5,"tags":[]}]' ELSE '[]' END
        || ',"mixed":' || CASE WHEN o_orderkey % 2 = 1 THEN '5' ELSE '{"x":{"y":[[1],[true]]}}' END
        || ',"currencies":{"C' || o_orderkey % 50 || '":{"name":"n"}}}' AS record"""
    )


DEEP_TYPES = """n AS (SELECT count(*) AS n, count(*) FILTER (o_orderkey % 2 = 0) AS even, count(*) FILTER (o_orderkey % 3 = 0) AS three,
      count(*) FILTER (o_orderkey % 3 = 1) AS four FROM orders),
    spots AS (SELECT unnest([
      {'path': 'key', 'type': 'BIGINT', 'n': n}, {'path': 'a', 'type': 'OBJECT', 'n': n}, {'path': 'a.b', 'type': 'OBJECT', 'n': n},
      {'path': 'a.b.c', 'type': 'OBJECT', 'n': n}, {'path': 'a.b.c.d', 'type': 'BIGINT', 'n': three}, {'path': 'a.b.c.d', 'type': 'STRING', 'n': four},
      {'path': 'a.b.c.d', 'type': 'VOID', 'n': n - three - four}, {'path': 'lines', 'type': 'ARRAY', 'n': n}, {'path': 'lines[]', 'type': 'OBJECT', 'n': 2 * even},
      {'path': 'lines[].n', 'type': 'BIGINT', 'n': even}, {'path': 'lines[].n', 'type': 'DECIMAL', 'n': even}, {'path': 'lines[].tags', 'type': 'ARRAY', 'n': 2 * even},
      {'path': 'lines[].tags[]', 'type': 'STRING', 'n': even}, {'path': 'lines[].tags[]', 'type': 'BIGINT', 'n': even}, {'path': 'mixed', 'type': 'BIGINT', 'n': n - even},
      {'path': 'mixed', 'type': 'OBJECT', 'n': even}, {'path': 'mixed.x', 'type': 'OBJECT', 'n': even}, {'path': 'mixed.x.y', 'type': 'ARRAY', 'n': even},
      {'path': 'mixed.x.y[]', 'type': 'ARRAY', 'n': 2 * even}, {'path': 'mixed.x.y[][]', 'type': 'BIGINT', 'n': even}, {'path': 'mixed.x.y[][]', 'type': 'BOOLEAN', 'n': even},
      {'path': 'currencies', 'type': 'OBJECT', 'n': n}]) AS spot FROM n)"""


@query(f"WITH {DEEP_TYPES} SELECT spot.path AS path, spot.type AS type, spot.n AS n_values FROM spots")
def infer_deep_types(spark, sf_dir):
    return observed.observed_types(deep_records(spark, sf_dir)).drop("ancestors")


@query(
    """SELECT * FROM (VALUES ('key', 'BIGINT'), ('a', 'OBJECT'), ('a.b', 'OBJECT'), ('a.b.c', 'OBJECT'), ('a.b.c.d', 'STRING'), ('lines', 'ARRAY'),
      ('lines[]', 'OBJECT'), ('lines[].n', 'DOUBLE'), ('lines[].tags', 'ARRAY'), ('lines[].tags[]', 'STRING'), ('mixed', 'STRING'), ('currencies', 'OBJECT')) AS t(path, type)
    WHERE (SELECT count(*) FROM orders) > 0"""
)
def infer_widened(spark, sf_dir):
    return observed.widened_types(observed.observed_types(deep_records(spark, sf_dir)))


@query(
    f"""WITH {RAW_CTE} SELECT common AS "name.common", official AS "name.official", region, subregion,
      CAST(population AS VARCHAR) AS population, CAST(area AS VARCHAR) AS area, capital, currencies FROM raw"""
)
def flatten_dotted(spark, sf_dir):
    flat_rows = observed.flatten_dotted(raw_orders(spark, sf_dir))
    return flat_rows.withColumns({"capital": F.to_json("capital"), "currencies": canonical_json(F.col("currencies"))})


PATHS = """CASE page_id % 4 WHEN 0 THEN 'raw/pages/' || page_id || '.json'
    WHEN 1 THEN 'raw/pages_old/' || page_id || '.json' WHEN 2 THEN 'raw/pages/raw/pages/' || page_id || '.json'
    ELSE 'raw/pages/' || page_id || '.keep' END"""


@query(
    f"""WITH paths AS (SELECT url, {PATHS} AS path FROM pages)
    SELECT url, path, path LIKE '%.json' AS is_record_file,
           CASE WHEN starts_with(path, 'raw/pages/') THEN regexp_replace(path, '^raw/pages/', 'archive/pages/') END
             AS archive_path FROM paths"""
)
def path_rewrite(spark, sf_dir):
    path = F.col("path")
    return (
        table(spark, sf_dir, "pages")
        .select("url", F.expr(PATHS).alias("path"))
        .withColumn("is_record_file", is_record_file(path))
        .withColumn("archive_path", rewrite_zone(path, "raw/pages", "archive/pages"))
    )


@query("SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS run_ts FROM events")
def event_run_stamp(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", run_stamp(F.col("ts")).alias("run_ts"))
