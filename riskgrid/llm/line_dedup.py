r"""Line dedup (operator 11) by levelled sorted runs of line hashes.

A line's key is the line without ``[\x20\x09-\x0D]`` at both ends, A-Z lowered;
keys of ``least_chars`` code points or more count, as 128-bit hashes.  Batches
of documents arrive from the largest ids down.  A batch's keys are counted
(distinct documents, largest id), merge-anti-joined with the runs, and what is
left becomes a new run at level 0.  A run holds (key, docs, top), bucketed and
sorted by key, so the anti-join moves none of its rows.  When a level has
``fanout`` runs they are compacted into one run of the next level.

The anti-join leaves out keys that a run has already settled: it counts them in
``least_docs`` documents, and as ids only fall, neither that verdict nor the
keeper (the largest id) can change.  Every other key adds its counts, and the
sum over all runs decides.  A settled key is thus written once, however many
batches hold it.

Runs live in one folder.  A run counts once its ``_SUCCESS`` file is there, its
name says which batches it covers, and a compacted run supersedes those within
its span: an interrupted job is continued by adding the same batches again.

Dropping joins the documents' keys with the repeated ones.  Keys that hold more
than 1 in ``HEAVY`` of all entries, at most ``HEAVY`` of them, are broadcast;
the others are joined by a shuffle in which no key is hot.

Null text is one empty line, as is an empty text.  Rows that share an id are one
document to the counts, and each keeps its row.  A null id is the smallest; rows
with it are one document.  A document loses all its lines with a repeated key
unless it is the keeper.  An empty table gives an empty result.  Only the id and
text columns are read, whatever else the table holds.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from uuid import uuid4

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import cut_lineage, shuffle_partitions, text_or_empty

LEAST_CHARS = 40
LEAST_DOCS = 5
FANOUT = 4
BATCHES = 6
HEAVY = 5_000
STRIP = " \t\n\x0b\x0c\r"


def line_key(line: str, least_chars: int) -> bytes | None:
    """The line's 128-bit key, or None if it is too short to count."""
    line = line.strip(STRIP)
    return xxhash.xxh3_128_digest(line.encode().lower()) if len(line) >= least_chars else None


def key_rows(docs: DataFrame, id_col: str, text_col: str, least_chars: int) -> DataFrame:
    """(id, key): each document's distinct keys."""
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("id", kind), T.StructField("key", T.BinaryType())])

    def rows(batches):
        for b in batches:
            at, keys = [], []
            for i, text in enumerate(b.column(1).to_pylist()):
                found = {line_key(x, least_chars) for x in text.split("\n") if len(x) >= least_chars} - {None}
                at += [i] * len(found)
                keys += found
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), pa.array(keys, pa.binary())], ["id", "key"])

    return docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")).mapInArrow(rows, schema)


@dataclass(frozen=True)
class Run:
    level: int
    first: int
    last: int
    buckets: int
    path: str

    def covers(self, other: Run) -> bool:
        return self.level > other.level and self.first <= other.first and other.last <= self.last


class LineRuns:
    """The runs below ``folder``, and what a batch does with them."""

    def __init__(self, spark: SparkSession, folder: str, id_type: T.DataType, least_docs: int = LEAST_DOCS, fanout: int = FANOUT):
        self.spark, self.folder, self.least_docs, self.fanout = spark, folder.rstrip("/"), least_docs, fanout
        self.id_type, self.tables = id_type, {}
        self.path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def runs(self) -> list[Run]:
        """Committed runs that no compacted run supersedes, newest batches last."""
        if not self.fs.exists(self.path(self.folder)):
            return []
        found = []
        for s in self.fs.listStatus(self.path(self.folder)):
            path = s.getPath().toString()
            m = re.search(r"/L(\d+)-(\d+)-(\d+)-(\d+)-\w+$", path)
            if m and self.fs.exists(self.path(f"{path}/_SUCCESS")):
                found.append(Run(*map(int, m.groups()), path))
        return sorted((r for r in found if not any(o.covers(r) for o in found)), key=lambda r: (r.first, r.level))

    def table(self, run: Run) -> DataFrame:
        """The run as a bucketed, sorted table; one an earlier session wrote is registered first."""
        if run.path not in self.tables:
            name = self.tables[run.path] = f"line_run_{uuid4().hex}"
            self.spark.sql(f"CREATE TABLE {name} (key BINARY, docs BIGINT, top {self.id_type.simpleString()}) USING parquet "
                           f"CLUSTERED BY (key) SORTED BY (key) INTO {run.buckets} BUCKETS LOCATION '{run.path}'")
        return self.spark.table(self.tables[run.path])

    def _write(self, rows: DataFrame, level: int, first: int, last: int) -> None:
        n, name = shuffle_partitions(self.spark), f"line_run_{uuid4().hex}"
        path = f"{self.folder}/L{level}-{first}-{last}-{n}-{uuid4().hex}"
        (rows.select("key", "docs", "top").repartition(n, "key").sortWithinPartitions("key")
         .write.bucketBy(n, "key").sortBy("key").option("path", path).saveAsTable(name))
        self.spark.sql(f"DROP TABLE {name}")  # files stay; the listing decides what is a run

    def add(self, rows: DataFrame, batch: int) -> None:
        """Count the batch's (id, key) rows, leave out settled keys, and add the rest as a run.
        A batch that is there already is left as it is."""
        runs = self.runs()
        if any(r.first <= batch <= r.last for r in runs):
            return
        rest = (rows.groupBy("key", "id").agg(F.lit(1).alias("one"))
                .groupBy("key").agg(F.count("*").alias("docs"), F.max("id").alias("top")))
        for r in runs:
            settled = self.table(r).filter(F.col("docs") >= self.least_docs).select("key")
            rest = rest.join(settled.hint("merge"), "key", "left_anti")
        self._write(rest, 0, batch, batch)
        self.compact()

    def compact(self) -> None:
        """Merge the runs of every full level into one of the next; the old ones go after it is there."""
        level = 0
        while runs := [r for r in self.runs() if r.level == level]:
            if len(runs) >= self.fanout:
                self._write(self._merged(runs), level + 1, runs[0].first, runs[-1].last)
                for r in runs:
                    if name := self.tables.pop(r.path, None):
                        self.spark.sql(f"DROP TABLE {name}")
                    self.fs.delete(self.path(r.path), True)
            level += 1

    def _merged(self, runs: list[Run]) -> DataFrame:
        """The runs' counts added up.  Read as plain files: a union of bucketed tables would be
        grouped as if equal keys lay in one partition (seen in Spark 4.1.2)."""
        rows = self.spark.read.schema(f"key BINARY, docs BIGINT, top {self.id_type.simpleString()}").parquet(*[r.path for r in runs])
        return rows.groupBy("key").agg(F.sum("docs").alias("docs"), F.max("top").alias("top"))

    def repeated(self) -> DataFrame:
        """(key, docs, top) of the keys in ``least_docs`` documents or more.  A settled key's
        ``docs`` ends at the batch that settled it; its ``top`` is final."""
        return self._merged(self.runs()).filter(F.col("docs") >= self.least_docs)


def falling_batches(docs: DataFrame, id_col: str, batches: int) -> Column:
    """The batch of each id: 0 has the largest ids, nulls come last.  Cuts are
    approximate quantiles, so they steer balance only."""
    if not isinstance(docs.schema[id_col].dataType, T.NumericType) or batches < 2:
        return F.lit(0)
    cuts = docs.agg(F.percentile_approx(id_col, [i / batches for i in range(1, batches)], 1000)).first()[0] or []
    below = sum((F.when(F.col("id") < F.lit(c), 1).otherwise(0) for c in sorted(set(cuts))), F.lit(0))
    return F.when(F.col("id").isNull(), len(set(cuts))).otherwise(below)


def dedup_lines(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS,
                least_docs: int = LEAST_DOCS, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """Per row: id, n_lines (before dropping), n_dropped and the text that is kept."""
    spark = docs.sparkSession
    keys = key_rows(docs, id_col, text_col, least_chars)
    path = f"{folder.rstrip('/')}/keys"
    keys.withColumn("batch", falling_batches(docs, id_col, batches)).write.mode("overwrite").partitionBy("batch").parquet(path)
    kind = docs.schema[id_col].dataType
    keys = spark.read.schema(T.StructType([T.StructField("id", kind), T.StructField("key", T.BinaryType()),
                                           T.StructField("batch", T.IntegerType())])).parquet(path)
    runs = LineRuns(spark, f"{folder.rstrip('/')}/runs", kind, least_docs, fanout)
    for n in range(max(1, batches)):
        runs.add(keys.filter(F.col("batch") == n), n)
    return drop_lines(docs, keys, cut_lineage(runs.repeated()), id_col, text_col, least_chars)


def drop_lines(docs: DataFrame, keys: DataFrame, repeated: DataFrame, id_col: str, text_col: str, least_chars: int) -> DataFrame:
    entries = keys.count()
    # keys with more than entries / HEAVY rows: at most HEAVY of them
    heavy = cut_lineage(keys.groupBy("key").count().filter(F.col("count") > entries / HEAVY)
                        .join(repeated.select("key", "top"), "key").select("key", "top"))
    light = repeated.join(F.broadcast(heavy.select("key")), "key", "left_anti").select("key", "top")
    hot = keys.select("id", "key").join(F.broadcast(heavy), "key")
    cold = keys.select("id", "key").join(F.broadcast(heavy.select("key")), "key", "left_anti").join(light, "key")
    lost = (hot.unionByName(cold).filter(~F.col("id").eqNullSafe(F.col("top")))
            .groupBy("id").agg(F.collect_set("key").alias("lost")))
    kind = docs.schema[id_col].dataType
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")).alias("d")
    rows = rows.join(lost.alias("l"), F.col("d.id").eqNullSafe(F.col("l.id")), "left").select("d.id", "text", "lost")
    schema = T.StructType([T.StructField(id_col, kind), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()),
                           T.StructField("text", T.StringType())])

    def kept(batches):
        for b in batches:
            n_lines, n_dropped, texts = [], [], []
            for text, gone in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                lines = text.split("\n")
                n_lines.append(len(lines))
                if gone:
                    gone = set(gone)
                    lines = [x for x in lines if line_key(x, least_chars) not in gone]
                    text = "\n".join(lines)
                n_dropped.append(n_lines[-1] - len(lines))
                texts.append(text)
            yield pa.RecordBatch.from_arrays([b.column(0).cast(to_arrow_type(kind)), pa.array(n_lines, pa.int64()),
                                              pa.array(n_dropped, pa.int64()), pa.array(texts, pa.string())],
                                             [id_col, "n_lines", "n_dropped", "text"])

    return rows.mapInArrow(kept, schema)


#: DuckDB twin of ``op11_line_runs``.
ORACLE = r"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT rid, doc_id, unnest(string_split(text, chr(10))) AS line,
             generate_subscripts(string_split(text, chr(10)), 1) AS i FROM t),
s AS (SELECT *, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM l),
k AS (SELECT *, CASE WHEN length(bare) >= 40
        THEN translate(bare, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') END AS key FROM s),
r AS (SELECT key, max(doc_id) AS top FROM k WHERE key IS NOT NULL GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.*, r.key IS NOT NULL AND k.doc_id IS DISTINCT FROM r.top AS gone FROM k LEFT JOIN r ON k.key = r.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY rid, doc_id
"""
