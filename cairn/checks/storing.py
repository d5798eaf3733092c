"""Queries over zones, catalog, archive, whole runs and incremental runs."""

from __future__ import annotations

import dataclasses

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.checks.binding import FLAT_CTE, RAW_CTE, order_objects, order_records, raw_orders
from cairn.checks.landing import leaves
from cairn.checks.registry import query, table
from cairn.checks.shaping import REGION_REPORT_ORACLE, RUN_DATE, TOP_K_ORACLE, curated_orders
from cairn.contracts import CURATED
from cairn.operators.catalog import (
    add_partitions,
    create_database,
    drop_partitions,
    drop_versions,
    register_table,
    register_version,
    repair_table,
    switch_version,
    version_path,
)
from cairn.operators.catalog import partition_difference as catalog_difference
from cairn.operators.reports import region_report, top_k_report
from cairn.operators.sinks import EmptyZone, land, materialize, read_audit, read_quality, write_zone
from cairn.operators.transforms import flatten
from cairn.plans.medallion import Run, run_local_variant, run_medallion, validate_zone
from cairn.sources.files import list_files
from cairn.sources.records import parse_records, read_records
from cairn.sources.zones import read_curated, read_table, read_valid, read_zone
from cairn.streaming.incremental import run_incremental, run_medallion_incremental
from cairn.workspace import scratch_path

CURATED_ORACLE = f"WITH {FLAT_CTE} SELECT *, '2024-01-31' AS load_date FROM flat"


def _dated(curated: DataFrame) -> DataFrame:
    return curated.withColumn("load_date", F.col("load_date").cast("string"))


def _stored(spark: SparkSession, sf_dir: str) -> str:
    return write_zone(curated_orders(spark, sf_dir), scratch_path(spark, "curated")).path


@query(CURATED_ORACLE)
def partition_roundtrip(spark, sf_dir):
    return _dated(read_curated(spark, _stored(spark, sf_dir)))


@query(f"{CURATED_ORACLE} WHERE region = '4-NOT SPECIFIED'")
def partition_prune(spark, sf_dir):
    return _dated(read_curated(spark, _stored(spark, sf_dir)).where(F.col("region") == "4-NOT SPECIFIED"))


def _overwritten(spark: SparkSession, sf_dir: str, partition_overwrite: str, partition_by: str | None) -> DataFrame:
    """All customers stored, then those of every segment but one stored over them with their balance negated."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    path = write_zone(customers, scratch_path(spark, "customers"), partition_by).path
    second = customers.where(F.col("c_mktsegment") != "BUILDING").withColumn("c_acctbal", -F.col("c_acctbal"))
    write_zone(second, path, partition_by, partition_overwrite=partition_overwrite)
    return read_zone(spark, path, customers.schema)


STATIC_ORACLE = "SELECT c_custkey, -c_acctbal AS c_acctbal, c_mktsegment FROM customer WHERE c_mktsegment <> 'BUILDING'"


@query(STATIC_ORACLE)
def overwrite_static(spark, sf_dir):
    return _overwritten(spark, sf_dir, "static", "c_mktsegment")


@query(
    """SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal ELSE -c_acctbal END AS c_acctbal,
      c_mktsegment FROM customer"""
)
def overwrite_dynamic(spark, sf_dir):
    return _overwritten(spark, sf_dir, "dynamic", "c_mktsegment")


@query(STATIC_ORACLE)
def overwrite_unpartitioned(spark, sf_dir):
    return _overwritten(spark, sf_dir, "static", None)


@query(
    f"""WITH {RAW_CTE}
    SELECT common AS country_name, nullif(region, '') AS region, population,
      CASE WHEN k % 8 = 0 THEN 'Alpha ' || k WHEN k % 4 = 0 THEN 'Zeta' WHEN k % 4 = 1 THEN 'Order unit' END AS currency_name
    FROM raw WHERE population > 0"""
)
def local_variant(spark, sf_dir):
    path = run_local_variant(raw_orders(spark, sf_dir), scratch_path(spark, "local")).path
    schema = "country_name string, region string, population bigint, currency_name string"
    return spark.read.schema(schema).parquet(path).select("country_name", "region", "population", "currency_name")


@query(REGION_REPORT_ORACLE)
def catalog_query(spark, sf_dir):
    database = "cairn_checks"
    create_database(spark, database, scratch_path(spark, "database"))
    register_table(spark, database, "curated_orders", CURATED, _stored(spark, sf_dir), replace=True)
    repair_table(spark, database, "curated_orders")
    return region_report(read_table(spark, database, "curated_orders"))


@query(REGION_REPORT_ORACLE)
def materialize_report(spark, sf_dir):
    report = region_report(curated_orders(spark, sf_dir))
    path = materialize(report, scratch_path(spark, "results"))
    return spark.read.schema(report.schema).option("header", True).csv(path)


@query(TOP_K_ORACLE)
def materialize_top_k(spark, sf_dir):
    report = top_k_report(curated_orders(spark, sf_dir))
    return spark.read.schema(report.schema).json(materialize(report, scratch_path(spark, "results"), "json"))


def _run(spark: SparkSession, sf_dir: str, **choices) -> Run:
    run = Run(scratch_path(spark, "lake"), "20240131_000000", RUN_DATE, "orders", **choices)
    run_medallion(spark, run, order_records(spark, sf_dir))
    return run


@query(CURATED_ORACLE)
def full_run(spark, sf_dir):
    return _dated(read_curated(spark, _run(spark, sf_dir).zones["curated"]))


@query(f"SELECT 'first' AS seen, * FROM ({CURATED_ORACLE}) UNION ALL SELECT 'second', * FROM ({CURATED_ORACLE}) WHERE subregion = 'O'")
def full_run_versioned(spark, sf_dir):
    """Two runs, each a version of the curated table; a reader of the first goes on with its rows after the second."""
    root, seen = scratch_path(spark, "lake"), []
    for name, run_ts, chosen in (("first", "20240131_000000", "true"), ("second", "20240201_000000", "o_orderstatus = 'O'")):
        run = Run(root, run_ts, RUN_DATE, "orders", replacement="versioned", database="cairn_checks", table="versioned_orders")
        run_medallion(spark, run, order_objects(spark, sf_dir).where(chosen).select("record"))
        seen.append(_dated(read_table(spark, run.database, run.table)).withColumn("seen", F.lit(name)))
    return seen[0].unionByName(seen[1])


@query(CURATED_ORACLE)
def full_run_without_intermediate(spark, sf_dir):
    return _dated(read_curated(spark, _run(spark, sf_dir, keep_intermediate=False).zones["curated"]))


# Two runs: one through all stages, and one whose records carry no population, which ends at the validation.
@query(
    f"""WITH {FLAT_CTE}, n AS (SELECT (SELECT count(*) FROM raw) AS rows_in, (SELECT count(*) FROM valid) AS rows_valid),
    lines AS (
      SELECT '20240131_000000' AS run_ts, unnest([
        {{'stage': 'ingest', 'a': rows_in, 'b': NULL, 'c': NULL, 'path': 'raw/orders/run_ts=20240131_000000', 'source': 'success'}},
        {{'stage': 'validate', 'a': rows_in, 'b': rows_valid, 'c': rows_in - rows_valid, 'path': 'validated/orders', 'source': NULL}},
        {{'stage': 'intermediate', 'a': rows_valid, 'b': NULL, 'c': NULL, 'path': 'intermediate/orders', 'source': NULL}},
        {{'stage': 'curate', 'a': rows_valid, 'b': NULL, 'c': NULL, 'path': 'curated/orders', 'source': NULL}},
        {{'stage': 'report', 'a': NULL, 'b': NULL, 'c': NULL, 'path': 'results/orders/run_ts=20240131_000000', 'source': NULL}}]) AS s FROM n
      UNION ALL SELECT '20240201_000000', unnest([
        {{'stage': 'ingest', 'a': rows_in, 'b': NULL, 'c': NULL, 'path': 'raw/orders/run_ts=20240201_000000', 'source': 'success'}},
        {{'stage': 'validate', 'a': NULL, 'b': NULL, 'c': NULL, 'path': NULL, 'source': NULL}}]) FROM n)
    SELECT run_ts, s.stage AS stage, CASE WHEN run_ts = '20240201_000000' AND s.stage = 'validate' THEN 'failure' ELSE 'success' END AS status,
      CAST(s.a AS BIGINT) AS rows_in, CAST(s.b AS BIGINT) AS rows_valid, CAST(s.c AS BIGINT) AS rows_rejected,
      CASE WHEN run_ts = '20240131_000000' AND s.stage = 'validate' THEN 0 END AS files_unaccounted, CASE WHEN s.stage = 'ingest' THEN 0 END AS bytes_unaccounted,
      s.path AS path, s.source AS source_status,
      CASE WHEN run_ts = '20240201_000000' AND s.stage = 'validate' THEN 'missing required columns: [''population'']' END AS error FROM lines"""
)
def run_audit(spark, sf_dir):
    """All columns of the audit. Files and bytes are held against what lies in the archive and the raw zone."""
    run = _run(spark, sf_dir)
    failing = dataclasses.replace(run, run_ts="20240201_000000")
    no_population = order_records(spark, sf_dir).select(F.regexp_replace("record", '"population":', '"people":').alias("record"))
    try:
        run_medallion(spark, failing, no_population)
    except ValueError:
        pass
    files = list_files(spark, run.zones["archive"]).unionByName(list_files(spark, run.zones["raw"]))
    stored = files.groupBy(F.regexp_extract("path", "run_ts=([0-9_]+)", 1).alias("run_ts")).agg(F.count_if(F.col("n_bytes") >= 0).alias("n_files"), F.sum("n_bytes").alias("n_stored"))
    audit = read_audit(spark, run.audit).join(F.broadcast(stored), "run_ts")
    # every line ends in a line feed
    bytes_apart = (F.col("n_stored") - F.col("rows_in") - F.col("n_bytes")).cast("int").alias("bytes_unaccounted")
    return audit.select(
        "run_ts", "stage", "status", "rows_in", "rows_valid", "rows_rejected", (F.col("n_files") - F.col("files_archived")).cast("int").alias("files_unaccounted"),
        bytes_apart, F.replace("path", F.lit(f"{run.root}/"), F.lit("")).alias("path"), "source_status", "error",
    )


@query(
    f"""WITH {RAW_CTE}, bad AS (SELECT *, k % 31 = 0 AS cut FROM raw)
    SELECT '20240131_000000' AS run_ts, 'validate' AS stage, unnest(['readable', 'name_required', 'population_required', 'region_required', 'population_min', 'region_folder']) AS rule,
      unnest([count(*) FILTER (cut), count(*) FILTER (NOT cut AND NOT has_name), count(*) FILTER (NOT cut AND population IS NULL),
        count(*) FILTER (NOT cut AND region IS NULL), count(*) FILTER (NOT cut AND coalesce(population, 0) <= 0), 0]) AS n_rows FROM bad"""
)
def run_quality(spark, sf_dir):
    """The rows that broke each rule, as the run's own writing pass counted them."""
    run = Run(scratch_path(spark, "lake"), "20240131_000000", RUN_DATE, "orders")
    cut = F.when(F.col("o_orderkey") % 31 == 0, F.left("record", F.lit(9))).otherwise(F.col("record"))
    run_medallion(spark, run, order_objects(spark, sf_dir).select(cut.alias("record")))
    return read_quality(spark, run.quality)


def _versions(spark: SparkSession, sf_dir: str, second: DataFrame) -> tuple[str, str]:
    """A database and a zone where the customers are the table's first version and ``second`` is written, but not shown."""
    database, zone = "cairn_checks", scratch_path(spark, "versioned")
    create_database(spark, database, scratch_path(spark, "database"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    for version, rows in (("v1", customers), ("v2", second)):
        made = write_zone(rows, version_path(zone, version), "c_mktsegment", report_partitions=True).partitions
        register_version(spark, database, "versioned_customers", version, customers.schema, zone, made, ["c_mktsegment"])
        if version == "v1":
            switch_version(spark, database, "versioned_customers", version)
    return database, zone


@query(f"SELECT 'before' AS seen, c_custkey, c_acctbal, c_mktsegment FROM customer UNION ALL SELECT 'after', * FROM ({STATIC_ORACLE})")
def replace_versioned(spark, sf_dir):
    """Readers by name between write and switch have the old rows, to the end, and those after it the new ones."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    second = customers.where(F.col("c_mktsegment") != "BUILDING").withColumn("c_acctbal", -F.col("c_acctbal"))
    database, zone = _versions(spark, sf_dir, second)
    before = read_table(spark, database, "versioned_customers").withColumn("seen", F.lit("before"))
    switch_version(spark, database, "versioned_customers", "v2")
    drop_versions(spark, database, "versioned_customers", zone, keep=1)
    return before.unionByName(read_table(spark, database, "versioned_customers").withColumn("seen", F.lit("after")))


@query(
    """SELECT c_custkey, c_acctbal, CAST(c_nationkey AS VARCHAR) AS c_nationkey FROM customer WHERE c_nationkey NOT IN (4, 5)
    UNION ALL SELECT c_custkey, -c_acctbal, '77' FROM customer WHERE c_nationkey = 3
    UNION ALL SELECT c_custkey, c_acctbal, NULL FROM customer WHERE c_nationkey = 4"""
)
def partition_difference(spark, sf_dir):
    """The catalog is told what writes report: a new partition shows, a dropped one is gone, and a folder nobody reported is never seen."""
    database, zone = "cairn_checks", scratch_path(spark, "partitioned")
    create_database(spark, database, scratch_path(spark, "database"))
    nation = F.when(F.col("c_nationkey") != 4, F.col("c_nationkey").cast("string")).alias("c_nationkey")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", nation)
    made = write_zone(customers, zone, "c_nationkey", report_partitions=True).partitions
    register_table(spark, database, "partitioned_customers", customers.schema, zone, ["c_nationkey"], replace=True)
    add_partitions(spark, database, "partitioned_customers", made)
    write_zone(customers.withColumn("c_nationkey", F.lit("ghost")), zone, "c_nationkey", partition_overwrite="dynamic")
    new = customers.where("c_nationkey = '3'").select("c_custkey", (-F.col("c_acctbal")).alias("c_acctbal"), F.lit("77").alias("c_nationkey"))
    more = write_zone(new, zone, "c_nationkey", partition_overwrite="dynamic", report_partitions=True).partitions
    added, dropped = catalog_difference(made, [p for p in made if p["c_nationkey"] != "5"] + more)
    add_partitions(spark, database, "partitioned_customers", added)
    drop_partitions(spark, database, "partitioned_customers", dropped)
    return read_table(spark, database, "partitioned_customers")


@query(
    f"""WITH {RAW_CTE} SELECT common AS country_name, official AS official_name, region, subregion, population, area, capital, currencies,
      CASE k % 3 WHEN 0 THEN 'run_ts=20240131_000000' WHEN 1 THEN 'deep/a' ELSE 'deep/b/c' END AS folder, CAST(0 AS BIGINT) AS files_left FROM raw"""
)
def batch_archive(spark, sf_dir):
    """Every record is found in the archive after the validation, in the folder it lay in, and no file in the raw zone."""
    run = Run(scratch_path(spark, "lake"), "20240131_000000", dataset="orders")
    records, third = order_objects(spark, sf_dir), F.col("o_orderkey") % 3
    land(records.where(third == 0).select("record"), run.zones["raw"], run.run_ts)
    for folder, share in (("deep/a", third == 1), ("deep/b/c", third == 2)):
        records.where(share).select("record").write.text(f"{run.zones['raw']}/{folder}")
    validate_zone(spark, run)
    archived = parse_records(read_records(spark, run.zones["archive"]))
    left = list_files(spark, run.zones["raw"]).count()
    folder = F.regexp_extract("file_path", "archive/orders/(.*)/[^/]*$", 1).alias("folder")
    return leaves(archived, folder, F.lit(left).cast("bigint").alias("files_left"))


def _two_runs(spark: SparkSession, sf_dir: str, keep: str) -> tuple[str, str]:
    """Closed and partial orders come first, open ones second, each drop followed by an incremental run."""
    root = scratch_path(spark, "incremental")
    raw, validated = f"{root}/raw", f"{root}/validated"
    is_open = F.col("o_orderstatus") == "O"
    for run_ts, drop in (("20240101_000000", ~is_open), ("20240102_000000", is_open)):
        land(order_objects(spark, sf_dir).where(drop).select("record"), raw, run_ts)
        run_incremental(spark, raw, validated, f"{root}/checkpoint", f"{root}/archive", keep).awaitTermination()
    return validated, f"{root}/archive"


FLAT_COLUMNS = "country_name, region, subregion, population, area, capital_city, currency"


@query(f"WITH {FLAT_CTE} SELECT {FLAT_COLUMNS} FROM flat WHERE subregion = 'O'")
def incremental_replace(spark, sf_dir):
    return flatten(read_valid(spark, _two_runs(spark, sf_dir, "replace")[0]))


@query(f"WITH {FLAT_CTE} SELECT {FLAT_COLUMNS}, CASE WHEN subregion = 'O' THEN 1 ELSE 0 END AS batch_id FROM flat")
def incremental_append(spark, sf_dir):
    validated = _two_runs(spark, sf_dir, "append")[0]
    batches = [
        flatten(read_valid(spark, f"{validated}/batch_id={batch}")).withColumn("batch_id", F.lit(batch)) for batch in (0, 1)
    ]
    return batches[0].unionByName(batches[1])


@query(f"{CURATED_ORACLE}")
def incremental_after_failure(spark, sf_dir):
    """Closed and partial orders come, and the run fails with their batch on the way; open ones come, and the next run has all."""
    run = Run(scratch_path(spark, "lake"), "20240131_000000", RUN_DATE, "orders")
    checkpoint, is_open = f"{run.root}/checkpoint", F.col("o_orderstatus") == "O"

    def fail(batch_id: int, counts: dict[str, int]) -> None:
        raise RuntimeError("the run is lost here")

    land(order_objects(spark, sf_dir).where(~is_open).select("record"), run.zones["raw"], "20240101_000000")
    try:
        run_incremental(spark, run.zones["raw"], run.zones["validated"], checkpoint, on_batch=fail)
    except StreamingQueryException:
        pass
    land(order_objects(spark, sf_dir).where(is_open).select("record"), run.zones["raw"], "20240102_000000")
    run_medallion_incremental(spark, run, checkpoint)
    return _dated(read_curated(spark, run.zones["curated"]))


@query(
    f"""WITH {FLAT_CTE}, n AS (SELECT (SELECT count(*) FROM raw) AS rows_in, (SELECT count(*) FROM valid) AS rows_valid)
    SELECT 'batch' AS stage, 'batch_id=0' AS path, 'success' AS status, rows_in, rows_valid, rows_in - rows_valid AS rows_rejected FROM n
    UNION ALL SELECT 'validate', 'validated/orders', 'success', rows_in, rows_valid, rows_in - rows_valid FROM n
    UNION ALL SELECT 'intermediate', 'intermediate/orders', 'success', rows_valid, NULL, NULL FROM n
    UNION ALL SELECT 'curate', 'curated/orders', 'success', rows_valid, NULL, NULL FROM n
    UNION ALL SELECT 'report', 'results/orders/run_ts=20240131_000000', 'success', NULL, NULL, NULL FROM n"""
)
def incremental_audit(spark, sf_dir):
    run = Run(scratch_path(spark, "lake"), "20240131_000000", RUN_DATE, "orders")
    land(order_records(spark, sf_dir), run.zones["raw"], run.run_ts)
    run_medallion_incremental(spark, run, f"{run.root}/checkpoint")
    path = F.replace("path", F.lit(f"{run.root}/"), F.lit("")).alias("path")
    return read_audit(spark, run.audit).select("stage", path, "status", "rows_in", "rows_valid", "rows_rejected")


@query(f"WITH {FLAT_CTE} SELECT {FLAT_COLUMNS} FROM flat")
def incremental_empty(spark, sf_dir):
    """A later run without a valid row fails and leaves the zone as it was."""
    root = scratch_path(spark, "incremental")
    raw, validated = f"{root}/raw", f"{root}/validated"
    no_people = F.regexp_replace("record", '"population":[0-9.]+', '"population":0').alias("record")
    for run_ts, records in (("1", order_records(spark, sf_dir)), ("2", order_records(spark, sf_dir).select(no_people))):
        land(records, raw, run_ts)
        try:
            run_incremental(spark, raw, validated, f"{root}/checkpoint", on_empty="fail")
        except EmptyZone:
            pass
    return flatten(read_valid(spark, validated))
