"""Line dedup over levelled sorted runs of line hashes, by DataFrame operations only.

A line's key is the line without blanks at both ends and with A-Z in lower case. Keys of at least
``MIN_CHARS`` code points are held once: by the smallest doc_id that has them. All their lines in
other documents go; other lines stay.

The keys of all lines are made once and staged by batch, ranges of ascending ids. ``LineRuns`` keeps the keys seen so far
as runs, each a table of one sorted file for each bucket of two 64-bit hashes. A batch's distinct keys, gathered
once by hash, are anti-joined with each run by merging: the runs are neither moved nor sorted. What is left becomes a new
run of level 0. As soon as a level has ``fan_in`` runs they are merged, bucket by bucket, into one of the next.

Null and empty texts are one empty line. Documents with a null id come last and count as one. Rows
with the same id are the same document. An empty table gives an empty result. A text that loses all
lines becomes empty. Other columns pass through, whatever their names.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.workspace import scratch_path

MIN_CHARS = 10
BLANKS = " \t\n\r\v\f"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LAST = 2**63 - 1
KEY = ["h1", "h2"]


def lower(text: Column) -> Column:
    """A-Z in lower case. ``translate`` goes letter by letter, ``lower`` is fast and right for ASCII."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def line_keys(documents: DataFrame) -> DataFrame:
    """``ident``, ``version`` (of the text), ``place`` and the two hashes of every line that has a key."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = documents.select(
        F.coalesce("doc_id", F.lit(LAST)).alias("ident"),
        F.xxhash64(text).alias("version"),
        F.posexplode(F.split(lower(text), "\n")).alias("place", "line"),
    )
    keyed = lines.withColumn("line", F.btrim("line", F.lit(BLANKS))).where(F.length("line") >= MIN_CHARS)
    return keyed.select("ident", "version", "place", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(7), "line").alias("h2"))


#: Lets a scan of one sorted file for each bucket count as sorted.
ORDERED = "spark.sql.legacy.bucketedTableScan.outputOrdering"


class LineRuns:
    """Keys with the smallest id that has them, given batches of ascending ids."""

    def __init__(self, spark: SparkSession, fan_in: int = 2):
        self.spark, self.fan_in = spark, fan_in
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[tuple[str, str]]] = [[]]

    def add(self, keys: DataFrame) -> None:
        self._write(self.fresh(keys), 0)
        for number, level in enumerate(self.levels):
            if len(level) >= self.fan_in:
                self._write(self.merged(level), number + 1)
                for table, _ in level:
                    self.spark.sql(f"DROP TABLE {table}")
                level.clear()

    def fresh(self, keys: DataFrame) -> DataFrame:
        """The distinct keys that no run has, with their smallest id."""
        new = keys.groupBy(*KEY).agg(F.min("ident").alias("owner"))
        for level in self.levels:
            for table, _ in level:
                new = new.join(self.spark.table(table).hint("merge"), KEY, "left_anti")
        return new

    def merged(self, runs: list[tuple[str, str]]) -> DataFrame:
        """Runs of different keys as one, by merging their buckets."""
        first, *others = (self.spark.table(table) for table, _ in runs)
        for other in others:
            both = first.join(other.withColumnRenamed("owner", "second").hint("merge"), KEY, "full_outer")
            first = both.select(*KEY, F.coalesce("owner", "second").alias("owner"))
        return first

    def owners(self) -> DataFrame:
        paths = [path for level in self.levels for _, path in level]
        return self.spark.read.schema("h1 long, h2 long, owner long").parquet(*paths)

    def close(self) -> None:
        """Forgets the tables' names; their files stay for whoever still reads ``owners``."""
        for level in self.levels:
            for table, _ in level:
                self.spark.sql(f"DROP TABLE {table}")

    def _write(self, run: DataFrame, level: int) -> None:
        """A run's buckets are each in one task already, so each is one file."""
        if level == len(self.levels):
            self.levels.append([])
        name, path = f"line_run_{uuid.uuid4().hex}", scratch_path(self.spark, "line-run")
        with ordered_scans(self.spark):
            run.write.format("parquet").bucketBy(self.buckets, *KEY).sortBy(*KEY).option("path", path).saveAsTable(name)
        self.levels[level].append((name, path))


@contextmanager
def ordered_scans(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(ORDERED, None)
    spark.conf.set(ORDERED, "true")
    try:
        yield
    finally:
        spark.conf.unset(ORDERED) if before is None else spark.conf.set(ORDERED, before)


def batch_bounds(documents: DataFrame, batches: int) -> list[int]:
    """Ids that part the documents into ranges of about equal counts."""
    shares = [k / batches for k in range(1, batches)]
    bounds = documents.select(F.percentile_approx("doc_id", shares, 10_000)).first()[0] if shares else None
    return sorted(set(bounds or []))


def staged_keys(documents: DataFrame, bounds: list[int]) -> DataFrame:
    """The keys of all lines, in a folder for each batch; a null id is in the last."""
    batch = sum((F.col("ident") > F.lit(bound)).cast("int") for bound in bounds) if bounds else F.lit(0)
    path = scratch_path(documents.sparkSession, "line-keys")
    keys = line_keys(documents).withColumn("batch", batch)
    keys.write.partitionBy("batch").parquet(path)
    return documents.sparkSession.read.schema("ident long, version long, place int, h1 long, h2 long, batch int").parquet(path)


def dedup_lines(documents: DataFrame, batches: int = 4, fan_in: int = 2) -> DataFrame:
    """``row`` (the document as a struct, with the lines it keeps as text), ``n_lines`` and ``n_dropped``."""
    runs = LineRuns(documents.sparkSession, fan_in)
    bounds = batch_bounds(documents, batches)
    keys = staged_keys(documents, bounds)
    for number in range(len(bounds) + 1):
        runs.add(keys.where(F.col("batch") == number))
    owners = runs.owners()
    runs.close()
    dropped = (
        keys.join(owners, KEY).where("owner < ident")
        .groupBy("ident", "version").agg(F.collect_set("place").alias("dropped"))
    )
    text = F.coalesce(F.col("text"), F.lit(""))
    whole = documents.select(
        F.struct(*(F.lit(None).alias("text") if c == "text" else F.col(c) for c in documents.columns)).alias("row"),
        F.coalesce("doc_id", F.lit(LAST)).alias("ident"),
        F.xxhash64(text).alias("version"),
        F.split(text, "\n").alias("lines"),
        F.col("text").isNull().alias("missing"),
    )
    joined = whole.join(dropped, ["ident", "version"], "left")
    places = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "dropped")
    kept = F.array_join(F.transform(places, lambda place: F.get("lines", place)), "\n")
    text = F.when(F.col("dropped").isNotNull(), kept).when(~F.col("missing"), F.array_join("lines", "\n"))
    return joined.select(
        F.struct(*(text.alias("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in documents.columns)).alias("row"),
        F.size("lines").cast("long").alias("n_lines"),
        F.when(F.col("dropped").isNotNull(), F.size("dropped")).otherwise(0).cast("long").alias("n_dropped"),
    )
