"""File sources and sinks.

Every reader is a plain ``spark.read`` with an explicit schema. Line order inside a file is
kept without reading files whole (see :func:`read_lines`); only the load-tool reports, which are
small by nature, are read whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.joins import small

OUTCOME_HEADER = 3   # [sent_count, seconds, rps]
OUTCOME_ROW = 5      # [req_id, sent, received, resp_time, result]


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """W8 for raw files: ``(file, line_no, value)`` with 0-based line numbers in file order.

    Files stay splittable: a line's number is the count of lines in the earlier splits of its file
    (a small per-split table) plus its position inside its own split. Splits are read
    sequentially, so positions inside a split are consecutive row ids; the same scan planned twice
    yields the same splits and ids.
    """
    raw = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_blk"),
        F.monotonically_increasing_id().alias("_rid"))
    splits = raw.groupBy("file", "_blk").agg(F.min("_rid").alias("_first"), F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy("file").orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0))).drop("_n")
    out = raw.join(small(splits), ["file", "_blk"])
    return out.select("file", (F.col("_before") + F.col("_rid") - F.col("_first")).alias("line_no"), "value")


def read_trace(spark: SparkSession, path: str) -> DataFrame:
    """Trace text files -> ``(file, line_no, line)`` (parse with ``operators.traces``)."""
    return read_lines(spark, path).where(F.col("value") != "").withColumnRenamed("value", "line")


RUN_LOG_SCHEMA = "url_idx INT, status STRING, cost DOUBLE"


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """Comma run log ``url_idx,status,cost`` with its source file."""
    return spark.read.schema(RUN_LOG_SCHEMA).csv(path).withColumn("source", F.input_file_name())


def read_series(spark: SparkSession, path: str) -> DataFrame:
    """Number-per-line series -> ``(file, i, value)`` in file order (blank lines skipped,
    ``i`` keeps the file line number)."""
    lines = read_lines(spark, path).where(F.trim("value") != "")
    return lines.select("file", F.col("line_no").alias("i"), F.trim("value").try_cast("double").alias("value"))


def read_outcomes(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Load-test result files -> (headers, outcomes).

    Each line is a bracketed list; 3 numbers form a worker header ``(sent, seconds, rps)``,
    5 numbers one request outcome. Lines are decoded as JSON arrays (no ``eval``).
    """
    rows = (spark.read.text(path).select(F.input_file_name().alias("file"),
                                         F.from_json(F.trim("value"), "array<double>").alias("a"))
            .where(F.col("a").isNotNull()))
    headers = rows.where(F.size("a") == OUTCOME_HEADER).select(
        "file", F.get("a", 0).cast("bigint").alias("sent"), F.get("a", 1).alias("seconds"), F.get("a", 2).alias("rps"))
    outcomes = rows.where(F.size("a") == OUTCOME_ROW).select(
        "file", F.get("a", 0).cast("bigint").alias("req_id"), F.get("a", 1).alias("sent"),
        F.get("a", 2).alias("received"), F.get("a", 3).alias("resp_time"), F.get("a", 4).cast("int").alias("result"))
    return headers, outcomes


def scrape_report(spark: SparkSession, path: str) -> DataFrame:
    """Load-tool reports -> throughput and mean time per request, found by label."""
    r = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), "value")
    return r.select("file",
                    F.regexp_extract("value", r"Requests per second:\s+([0-9.]+)", 1).try_cast("double").alias("rps"),
                    F.regexp_extract("value", r"Time per request:\s+([0-9.]+) \[ms\] \(mean\)", 1)
                    .try_cast("double").alias("time_per_request"))


def read_tsv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """TAB-separated file with a header line."""
    r = spark.read.option("sep", "\t").option("header", True)
    return (r.schema(schema) if schema else r).csv(path)


def read_route_table(spark: SparkSession, path: str) -> DataFrame:
    """``label;address`` lines; everything after the first ``;`` is the address.
    ``ord`` keeps the file order for first-match lookups."""
    lines = read_lines(spark, path).where(F.col("value") != "")
    parts = F.split("value", ";", 2)
    return lines.select(F.get(parts, 0).alias("label"), F.get(parts, 1).alias("address"),
                        F.struct("file", "line_no").alias("ord"))


def first_row(df: DataFrame, order: str) -> DataFrame:
    """The first row of a table (e.g. a JDBC ``proxy`` table) by an explicit order.
    Planned as a distributed top-1 (TakeOrderedAndProject), not a full sort."""
    return df.orderBy(order).limit(1)


def read_proxy(spark: SparkSession, url: str, table: str = "proxy", properties: dict | None = None,
               order: str = "server_ip") -> DataFrame:
    """``(server_ip, server_port)`` of the first proxy row in a relational table (JDBC; the
    driver jar must be on the classpath)."""
    df = spark.read.jdbc(url, table, properties=properties or {})
    return first_row(df.select("server_ip", "server_port"), order)


def write_tsv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Metric outputs as TAB-separated files."""
    df.write.mode(mode).option("sep", "\t").csv(path)
