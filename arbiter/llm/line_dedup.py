"""Line de-duplication over levelled sorted runs of line hashes.

Every key (a stripped, A-Z lower-cased line) has one owner: the first batch that brought it and, in
that batch, the smallest document id. Owners lie in runs: Parquet tables bucketed and sorted by
hash. A batch is reduced to one row per key and merge-joined to every run in turn, which brings the owners of
keys that a run holds; the others, the anti-join's rows, become a run of level 0. ``fanout`` runs of one level are merged into one of the next, so a
batch meets few runs however many came before.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from functools import reduce

import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arbiter.llm.common import hot_join, map_rows, stage, utf8, work_path

#: Documents without an id count as one document, later than every other.
NO_ID = 2 ** 63 - 1


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """128-bit hash of a line's key, or None when the key is shorter than ``min_chars`` code points.

    bytes.strip() and bytes.lower() touch exactly the ASCII white space and A-Z.
    """
    key = line.strip().lower()
    if len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars:
        return None
    return xxhash.xxh3_128_digest(key)


#: Hashes a bucket of a run is meant to hold, and the fewest buckets.
BUCKET_ROWS, LEAST_BUCKETS = 4_000_000, 16


class LineRuns:
    """Levelled runs of (hash, owner) in a shared folder ``path``; opening it again goes on with them.

    The live runs stand in numbered lists, each written whole into a folder of its own; the highest complete one counts. A
    job that dies before its list is written leaves the index as it was. ``buckets`` is set when the folder is made (from
    ``expected`` hashes where not given) and kept in the lists.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None, fanout: int = 4, expected: int = 0):
        self.spark, self.path, self.fanout = spark, path, fanout
        self.number, found = self._listed()
        if found is None:
            found = {"buckets": buckets or max(LEAST_BUCKETS, -(-expected // BUCKET_ROWS)), "runs": []}
        if buckets and buckets != found["buckets"]:
            raise ValueError(f"{path} has {found['buckets']} buckets, not {buckets}")
        self.buckets: int = found["buckets"]
        self.runs: list[tuple[int, str]] = [(level, folder) for level, folder in found["runs"]]
        if self.number < 0:
            self._commit([])

    def _folders(self, path: str) -> dict[str, bool]:
        """Name of every folder below ``path``, and whether its writing was completed."""
        root = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        made = [x.getPath() for x in fs.listStatus(root)] if fs.exists(root) else []
        return {x.getName(): fs.exists(x.suffix("/_SUCCESS")) for x in made}

    def _listed(self) -> tuple[int, dict | None]:
        """Number and content of the last complete list; -1 for a new folder. Runs without any list are an error."""
        lists = sorted(int(name) for name, whole in self._folders(f"{self.path}/lists").items() if whole)
        if not lists:
            if any(name.startswith("run-") for name in self._folders(self.path)):
                raise ValueError(f"{self.path} holds runs, but no list of them")
            return -1, None
        return lists[-1], json.loads(self.spark.read.text(f"{self.path}/lists/{lists[-1]:08d}").first()[0])

    def _commit(self, runs: list[tuple[int, str]]) -> None:
        """A run counts once the list that names it is complete; what an earlier try left under the next number is replaced."""
        line = json.dumps({"buckets": self.buckets, "runs": runs})
        self.number += 1
        self.spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.path}/lists/{self.number:08d}")
        self.runs = runs

    def _table(self, folder: str) -> DataFrame:
        name = f"line_run_{folder.replace('-', '_')}"
        self.spark.sql(f"""CREATE TABLE IF NOT EXISTS {name} (h BINARY, owner BIGINT) USING parquet
                           CLUSTERED BY (h) SORTED BY (h) INTO {self.buckets} BUCKETS LOCATION '{self.path}/{folder}'""")
        return self.spark.table(name)

    def _write(self, rows: DataFrame) -> str:
        folder = f"run-{uuid.uuid4().hex[:12]}"
        self._table(folder)
        # dealt by bucket, so that a bucket is one file however many partitions there are; four to a bucket, as few meet then
        bucket = F.pmod(F.hash("h"), F.lit(self.buckets))
        (rows.select("h", "owner", bucket.alias("_bucket")).repartition(4 * self.buckets, "_bucket").sortWithinPartitions("_bucket", "h")
         .drop("_bucket").write.insertInto(f"line_run_{folder.replace('-', '_')}"))
        return folder

    def owners(self) -> Iterator[DataFrame]:
        return (self._table(folder) for _, folder in self.runs)

    def add(self, keys: DataFrame) -> DataFrame:
        """``keys``: h, first, last, n of one batch, one row per hash. Stores the hashes that no run
        holds and returns, for hashes that are held twice or more, h, owner and n."""
        met, held = keys, [F.lit(None).cast("long")]
        for i, run in enumerate(self.owners()):
            met = met.join(run.select("h", F.col("owner").alias(f"_held{i}")).hint("merge"), "h", "left")
            held.append(F.col(f"_held{i}"))
        met = stage(met.select("h", "first", "last", "n", F.coalesce(*held).alias("held")), "line-met")
        fresh = met.filter("held is null").withColumnRenamed("first", "owner")
        runs = [*self.runs, (0, self._write(fresh))]
        level = 0
        while len(due := [f for at, f in runs if at == level]) >= self.fanout:
            merged = self._table(due[0])
            for folder in due[1:]:
                merged = merged.unionByName(self._table(folder))
            runs = [r for r in runs if r[0] != level] + [(level + 1, self._write(merged))]
            level += 1
        self._commit(runs)
        return met.filter("held is not null or last > first").select("h", F.coalesce("held", "first").alias("owner"), "n")


def line_hashes(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """doc, h: the distinct keys of every row's whole text."""
    def hashes(doc, text):
        return ((doc, h) for h in {line_key(x, min_chars) for x in text.split(b"\n")} if h is not None)
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)), utf8(F.col(text_col)))
    return map_rows(rows, hashes, "doc long, h binary")


def deduplicate_lines(docs: DataFrame, runs: LineRuns | None = None, id_col: str = "doc_id", text_col: str = "text",
                      min_chars: int = 10, batches: int = 4) -> DataFrame:
    """``docs`` with the lines dropped that another document owns; adds n_lines and n_dropped.

    A key of at least ``min_chars`` code points keeps its lines only in its owner. ``docs`` is fed
    in ``batches`` ranges of ascending id, so over new runs the owner is the smallest id that holds the
    key; runs with earlier content own what they hold. A null text is one empty line and comes out
    empty. Rows with one id are one document: none drops what only they hold. Rows without an id are
    one document after all others. An empty table gives no rows. Columns with any other names pass
    through; n_lines and n_dropped of the input are replaced.
    """
    spark = docs.sparkSession
    found = stage(line_hashes(docs, id_col, text_col, min_chars), "line-hashes")
    total = found.count()
    runs = runs or LineRuns(spark, work_path(spark, "line-runs"), expected=total)
    shares = [i / batches for i in range(1, batches)]
    cuts = list(dict.fromkeys(found.approxQuantile("doc", shares, 0.01))) if shares else []
    edges = [None, *[int(c) for c in cuts], None]
    owned = []
    for low, high in zip(edges, edges[1:], strict=False):
        batch = found
        batch = batch.filter(F.col("doc") > low) if low is not None else batch
        batch = batch.filter(F.col("doc") <= high) if high is not None else batch
        owned.append(runs.add(batch.groupBy("h").agg(F.min("doc").alias("first"), F.max("doc").alias("last"), F.count("*").alias("n"))))
    # a key has one owner in all batches; batches that met it once and without an owner brought that owner
    decided = reduce(DataFrame.unionByName, owned).groupBy("h").agg(F.min("owner").alias("owner"), F.sum("n").alias("n"))
    drops = hot_join(found, stage(decided, "line-owners"), ["h"], "n", total).filter("owner <> doc").select("doc", "h")
    lists = drops.groupBy("doc").agg(F.collect_set("h").alias("_drop"))

    @F.udf("n_lines long, n_dropped long, text string", useArrow=True)
    def cut(text: str | None, drop: list | None):
        lines = (text or "").encode().split(b"\n")
        gone = set(drop or ())
        kept = [x for x in lines if line_key(x, min_chars) not in gone] if gone else lines
        return len(lines), len(lines) - len(kept), b"\n".join(kept).decode()

    marked = docs.drop("n_lines", "n_dropped").withColumn("_doc", F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)))
    made = (marked.join(lists.withColumnRenamed("doc", "_doc").hint("merge"), "_doc", "left")
            .withColumn("_cut", cut(F.col(text_col), F.col("_drop"))))
    return made.withColumns({text_col: F.col("_cut.text"), "n_lines": F.col("_cut.n_lines"),
                             "n_dropped": F.col("_cut.n_dropped")}).drop("_cut", "_drop", "_doc")
