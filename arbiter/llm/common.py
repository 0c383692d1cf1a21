"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arbiter.operators.joins import estimated_bytes
from arbiter.session import checkpoint_dir

# The characters that separate words, and one word.
WHITE = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"
# A key is hot when it holds over 1/HOT_SHARE of the rows; there are fewer than HOT_SHARE such keys.
HOT_SHARE = 1000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` as a table into the shared folder and go on from the copy."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def utf8(text: Column) -> Column:
    """The text as UTF-8 bytes; null counts as empty."""
    return F.coalesce(text, F.lit("")).cast("binary")


def row_key(id_col: str, text_col: str) -> Column:
    """SHA-256 of id and text, never null: rows with one key are alike in both."""
    part = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-"))
    return F.unhex(F.sha2(F.concat(part(id_col), F.lit("\n"), part(text_col)), 256))


def hot_join(left: DataFrame, right: DataFrame, keys: list[str], rows: str, total: int,
             how: str = "inner") -> DataFrame:
    """Join ``left`` to ``right`` (one row per key, ``rows`` = rows of ``left`` that hold the key).

    Keys with over ``total / HOT_SHARE`` rows, of which fewer than HOT_SHARE exist, are broadcast
    and joined where their rows lie; only the others are shuffled, so no key fills a task.
    ``how`` is ``inner`` or ``left``; keys are not null.
    """
    hot = F.broadcast(right.filter(F.col(rows) * HOT_SHARE > total))
    rest = right.filter(F.col(rows) * HOT_SHARE <= total)
    there = left.join(hot, keys, "inner")
    other = left.join(hot.select(*keys), keys, "left_anti").join(rest.hint("merge"), keys, how)
    return there.unionByName(other)


def map_rows(df: DataFrame, fn: Callable[..., Iterable[tuple]], schema: str, rows: int = 256) -> DataFrame:
    """``fn(*columns of one row) -> tuples`` over every row, in Arrow batches of bounded size.

    Output batches are cut after 4,096 tuples, so a row with many results doesn't pile up.
    """
    names = [f.split()[0] for f in schema.split(",")]
    arrow = _arrow_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                for row in zip(*[c.to_pylist() for c in part.columns], strict=True):
                    for made in fn(*row):
                        out.append(made)
                        if len(out) >= 4096:
                            yield _batch(out, names, arrow)
                            out = []
        if out:
            yield _batch(out, names, arrow)

    return df.mapInArrow(run, schema)


def _arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(spark.createDataFrame([], schema).schema)


def _batch(rows: list[tuple], names: list[str], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(c, type=t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=names)


def shard_count(df: DataFrame, shard_bytes: int, least: int) -> int:
    """Shards of about ``shard_bytes`` by Catalyst's estimate of ``df``'s size; ``least`` when it has none."""
    size = estimated_bytes(df)
    return least if size is None or size >= 1 << 60 else max(least, -(-size // shard_bytes))


def global_rank(df: DataFrame, order: list[Column], name: str, rank: str = "rank") -> DataFrame:
    """0-based rank over all rows, without a single-task window.

    Rows are range-partitioned, ranked inside their partition and shifted by the counts of the
    partitions before (one row per partition, broadcast).
    """
    from pyspark.sql import Window as W
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = stage(df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()), name)
    counts = parts.groupBy("_part").count()
    before = counts.select(F.col("_part").alias("_p"), F.col("count").alias("_n"))
    shift = (counts.join(F.broadcast(before), F.col("_p") < F.col("_part"), "left")
             .groupBy("_part").agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_shift")))
    inner = F.row_number().over(W.partitionBy("_part").orderBy(*order)) - 1
    return (parts.withColumn("_inner", inner).join(F.broadcast(shift), "_part")
            .withColumn(rank, (F.col("_inner") + F.col("_shift")).cast("long"))
            .drop("_part", "_inner", "_shift"))
