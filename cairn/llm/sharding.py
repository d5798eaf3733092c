"""Proportional stratified interleaving of documents into shards, by DataFrame operations only.

Rows are put in a seeded random order within each source; a row's place is its fractional rank there,
(rank + start) / rows of the source, with a seeded start for each source. All rows are sorted by
place, and the sequence is cut into shards whose row counts differ by at most one, so each shard has
the mixture of the whole (law ``rows``).

No rank is found in one task: rows are dealt by a range of their random number (within the source),
then by a range of their place, both of which spread any source evenly; prefix sums of the counts of
these ranges give the offsets. The random number is drawn from id, checksum and size, so rows that share an
id are spread as well; rows equal in all three are one row with a count until their ranks are known, and are
taken apart in blocks. Only ids, sizes and checksums are shuffled.

A null source is a source of its own; a null text has size 8 and the checksum of no bytes; a null id
counts as empty text. Ties fall to id, checksum and size; rows equal in all of them are
interchangeable. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEAST_RANGES = 512
#: Equal rows that are taken apart together.
BLOCK = 4096


def draw(seed: int, value: Column) -> Column:
    """60 random bits that depend on the seed and a text alone."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), value).cast("binary")), 1, 15), 16, 10).cast("long")


def shard_documents(documents: DataFrame, shards: int = 24, seed: int = 1, rows_per_range: int = 20_000, source: str = "source") -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard`` and ``source`` of every row."""
    total = documents.count()
    ranges = max(LEAST_RANGES, -(-total // rows_per_range))
    rows = documents.select(
        F.col("doc_id").cast("long"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.col(source).cast("string").alias("source"),
        F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("")).alias("stratum"),
    )
    identity = F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text_crc32", "size")
    # equal rows are interchangeable: one row with their number
    rows = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n")).withColumn("draw", draw(seed, identity))
    rows = rows.withColumn("bucket", F.shiftright(F.shiftright("draw", 20) * F.lit(ranges), 40))

    ordered = Window.partitionBy("stratum").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (
        rows.groupBy("stratum", "bucket").agg(F.sum("n").alias("count"))
        .withColumn("before", F.coalesce(F.sum("count").over(ordered), F.lit(0)))
        .withColumn("stratum_rows", F.sum("count").over(Window.partitionBy("stratum")))
        .withColumn("start", draw(seed + 1, F.col("stratum")) / F.lit(2.0**60))
        .drop("count")
    )
    ties = ["draw", "doc_id", "text_crc32", "size"]
    within = Window.partitionBy("stratum", "bucket").orderBy(*ties).rowsBetween(Window.unboundedPreceding, 0)
    ranked = rows.join(buckets, ["stratum", "bucket"]).withColumn("first", F.col("before") + F.sum("n").over(within) - F.col("n"))
    # blocks first, dealt anew, so that no task takes a large group apart alone
    blocks = ranked.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(BLOCK).cast("long"))).alias("low")).repartition("draw", "low")
    single = blocks.select("*", F.explode(F.sequence("low", F.least(F.col("low") + BLOCK, F.col("n")) - 1)).alias("copy"))
    placed = (
        single.withColumn("rank", F.col("first") + F.col("copy"))
        .withColumn("place", (F.col("rank") + F.col("start")) / F.col("stratum_rows"))
        .withColumn("band", F.least(F.floor(F.col("place") * ranges), F.lit(ranges - 1)))
    )
    earlier = Window.orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    bands = placed.groupBy("band").count().select("band", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("offset"))
    across = Window.partitionBy("band").orderBy("place", *ties)
    sequence = placed.join(bands, "band").withColumn("position", F.col("offset") + F.row_number().over(across) - 1)
    shard = F.expr(f"position * {shards} div {max(total, 1)}")
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return sequence.withColumn("shard", shard).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
        (F.col("position") - first).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "source",
    )
