"""The raw record contract bound to the orders table.

Orders hold no NULLs, so missing, blank and zero values come from key arithmetic. Every order
becomes a record; the arithmetic only decides which of its fields are filled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cairn.checks.registry import table

# Field expressions in SQL that Spark and DuckDB read alike.
NAME_COMMON = "CASE WHEN o_orderkey % 19 <> 0 THEN 'O' || o_orderkey END"
NAME_OFFICIAL = "CASE WHEN o_orderkey % 19 <> 0 AND o_orderkey % 5 <> 1 THEN 'Order ' || o_orderkey END"
REGION = """CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN ''
            ELSE o_orderpriority END"""
POPULATION = """CASE WHEN o_orderkey % 7 = 0 THEN 0 WHEN o_orderkey % 17 = 0 THEN NULL
                ELSE CAST(floor(o_totalprice) AS BIGINT) END"""
AREA = "CAST(o_custkey % 7 AS DOUBLE)"

# JSON text of a record's capital and currencies, as they are read.
CAPITAL_TEXT = """CASE WHEN {0} % 15 = 0 THEN '[null]' WHEN {0} % 3 = 0 THEN '["' || {1} || '","x"]' WHEN {0} % 3 = 1 THEN '[]' END"""
CURRENCY_TEXT = """CASE {0} % 4
             WHEN 0 THEN '{{"AAB":{{"name":"Alpha ' || {0} || '","parts":{{"of":[' || {0} % 5 || ',null],"unit":"cent"}},"symbol":"a"}},"ZZY":{{"name":"'
                         || CASE WHEN {0} % 8 = 0 THEN '' ELSE 'Zeta' END || '"}}}}'
             WHEN 1 THEN '{{"ORD":{{"name":"Order unit"}}}}'
             WHEN 2 THEN '{{}}' ELSE '' END"""

# With clauses for the oracles: every record, the valid ones, and their flat form.
RAW_CTE = f"""raw AS (
    SELECT o_orderkey AS k, o_orderkey % 19 <> 0 AS has_name, {NAME_COMMON} AS common,
           {NAME_OFFICIAL} AS official, {REGION} AS region, o_orderstatus AS subregion,
           {POPULATION} AS population, {AREA} AS area,
           {CAPITAL_TEXT.format("o_orderkey", "o_orderstatus")} AS capital, {CURRENCY_TEXT.format("o_orderkey")} AS currencies
    FROM orders)"""
VALID_CTE = f"""{RAW_CTE}, valid AS (
    SELECT * FROM raw WHERE has_name AND region IS NOT NULL AND population > 0)"""
FLAT_CTE = f"""{VALID_CTE}, flat AS (
    SELECT common AS country_name, nullif(region, '') AS region, subregion, population, area,
           CASE WHEN k % 15 = 0 THEN NULL WHEN k % 3 = 0 THEN subregion ELSE '' END AS capital_city,
           {CURRENCY_TEXT.format("k")} AS currency
    FROM valid)"""


NAME = f"CASE WHEN o_orderkey % 19 <> 0 THEN named_struct('common', {NAME_COMMON}, 'official', {NAME_OFFICIAL}) END"
CAPITAL = """CASE WHEN o_orderkey % 15 = 0 THEN array(CAST(NULL AS STRING))
    WHEN o_orderkey % 3 = 0 THEN array(o_orderstatus, 'x')
    WHEN o_orderkey % 3 = 1 THEN CAST(array() AS ARRAY<STRING>) END"""
CURRENCIES = """CASE o_orderkey % 4
    WHEN 0 THEN map('ZZY', to_variant_object(named_struct('name', if(o_orderkey % 8 = 0, '', 'Zeta'), 'symbol', CAST(NULL AS STRING))),
                    'AAB', to_variant_object(named_struct('symbol', 'a', 'name', 'Alpha ' || o_orderkey, 'parts',
                        named_struct('unit', 'cent', 'of', array(o_orderkey % 5, NULL), 'none', CAST(NULL AS STRING)))))
    WHEN 1 THEN map('ORD', to_variant_object(named_struct('name', 'Order unit', 'symbol', CAST(NULL AS STRING))))
    WHEN 2 THEN CAST(map() AS MAP<STRING, VARIANT>) END"""


def _members(population: str, area: str) -> dict[str, str]:
    return {
        "name": NAME,
        "region": REGION,
        "subregion": "o_orderstatus",
        "population": population,
        "area": area,
        "capital": CAPITAL,
        "currencies": CURRENCIES,
    }


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed raw records, numbers as text, as the contract reads them."""
    members = _members(f"CAST({POPULATION} AS STRING)", f"CAST({AREA} AS STRING)")
    return table(spark, sf_dir, "orders").selectExpr(*[f"{member} AS {name}" for name, member in members.items()])


def order_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``o_orderkey``, ``o_orderstatus`` and each order's record as JSON text.

    Populations are fractions here, to be truncated. Even keys leave NULL fields out, odd keys spell them.
    """
    fraction = POPULATION.replace("CAST(floor(o_totalprice) AS BIGINT)", "o_totalprice")
    members = ", ".join(f"'{name}', {member}" for name, member in _members(fraction, AREA).items())
    record = f"""CASE WHEN o_orderkey % 2 = 0 THEN to_json(named_struct({members}))
        ELSE to_json(named_struct({members}), map('ignoreNullFields', 'false')) END"""
    return table(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_orderstatus", f"{record} AS record")


def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_objects(spark, sf_dir).select("record")
