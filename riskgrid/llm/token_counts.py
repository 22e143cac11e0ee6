"""Token counts by separator scan (operator 6).

A token file is a flat run of little-endian ids in which every document ends
with a separator id; nothing says where documents start.  The scan reads it in
blocks, finds all separators of a block at once, and stitches documents that
cross blocks: with the block's start (a prefix sum of block lengths) and the
last separator before it (a prefix maximum), the first document of a block is
as long as the gap between the two; the others lie inside.  The prefix scan has
two levels, blocks within groups of ``GROUP`` and then groups, so no task gets
all blocks of a large file.

``write_stream`` makes such files from documents: one flat stream per input
partition, cut into fixed-size blocks that ignore document bounds and stored as
compressed Parquet rows (shard, no, payload), plus the order of the ids.
``flat_file_blocks`` reads blocks of raw binary files instead.

Null and empty texts have no tokens.  Null ids and repeated rows keep their
place in the order.  Empty tables give empty results.  Only the id and text
columns are read.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut_lineage, text_or_empty

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
SEPARATOR = 50256  # free in this vocabulary
BLOCK_BYTES = 1 << 18
GROUP = 4096
_DTYPES = {2: "<u2", 4: "<u4"}
_LOADED: dict[str, object] = {}


def tokenizer(path: str):
    """The byte-level BPE of a rank file, loaded once per process."""
    if path not in _LOADED:
        import public_tokenizers
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _LOADED[path] = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _LOADED[path]


# fixed values: white space as the tokenizers' pattern has it
_SPACE = "[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_LONG_SPACE = re.compile(_SPACE + "{4096,}")


def encode(encoding, text: str) -> list[int]:
    """The text's ids.  The pattern's way through a very long run of white space overflows its
    stack, so such a run is encoded by itself: the pattern makes one piece of all of it but
    the last character, which it leaves to what follows (of all of it at the text's end)."""
    out, at = [], 0
    for run in _LONG_SPACE.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        out += encoding.encode_ordinary(text[at:run.start()])
        out += encoding._encode_single_piece(text[run.start():end].encode())
        at = end
    return out + encoding.encode_ordinary(text[at:]) if at else encoding.encode_ordinary(text)


def write_stream(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY,
                 separator: int = SEPARATOR, width: int = 2, block_bytes: int = BLOCK_BYTES) -> None:
    """Write ``docs`` as token streams under ``path``: kind=block rows (shard,
    no, payload) and kind=doc rows (shard, no, id), in stream order."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoding, shard = tokenizer(vocabulary), TaskContext.get().partitionId()
        end = np.array([separator], _DTYPES[width]).tobytes()
        held, block, doc = bytearray(), 0, 0

        def frame(kind: str, nos: range, payloads: list, ids: list) -> pd.DataFrame:
            return pd.DataFrame({"kind": kind, "shard": shard, "no": list(nos), "payload": payloads, "id": ids})

        for b in batches:
            for text in b["text"]:
                held += np.array(encode(encoding, text), _DTYPES[width]).tobytes() + end
                if len(held) >= 16 * block_bytes:
                    full = len(held) // block_bytes
                    yield frame("block", range(block, block + full), [bytes(held[i * block_bytes:(i + 1) * block_bytes]) for i in range(full)], [None] * full)
                    del held[:full * block_bytes]
                    block += full
            yield frame("doc", range(doc, doc + len(b)), [None] * len(b), list(b["id"]))
            doc += len(b)
        rest = [bytes(held[i:i + block_bytes]) for i in range(0, len(held), block_bytes)]
        if rest:
            yield frame("block", range(block, block + len(rest)), rest, [None] * len(rest))

    rows = docs.select(F.col(id_col).cast("string").alias("id"), text_or_empty(text_col).alias("text"))
    (rows.mapInPandas(run, "kind string, shard int, no bigint, payload binary, id string")
     .write.partitionBy("kind").option("compression", "zstd").parquet(path))


def flat_file_blocks(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(shard, no, payload) of raw token files; the shard is the file's path.
    Tasks read their byte ranges through the file system of the path's scheme."""
    files = (spark.read.format("binaryFile").load(path).select(F.col("path").alias("shard"), "length").filter("length > 0")
             .select("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(length - 1) div {block_bytes}"))).alias("no")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs
        for b in batches:
            for shard, no in zip(b["shard"], b["no"]):
                store, name = fs.FileSystem.from_uri(shard if "://" in shard else shard.replace("file:/", "file:///", 1))
                with store.open_input_file(name) as f:
                    f.seek(int(no) * block_bytes)
                    yield pd.DataFrame({"shard": [shard], "no": [no], "payload": [f.read(block_bytes)]})

    return files.repartition("shard", "no").mapInPandas(run, "shard string, no bigint, payload binary")


def document_lengths(blocks: DataFrame, separator: int = SEPARATOR, width: int = 2) -> DataFrame:
    """(shard, seq, n_tokens, closed) for every document of the streams.  Tokens
    after the last separator are one more document, with ``closed`` false."""
    kind = dict(blocks.dtypes)["shard"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for shard, no, payload in zip(b["shard"], b["no"], b["payload"]):
                ids = np.frombuffer(payload, _DTYPES[width])
                at = np.flatnonzero(ids == separator)
                out.append((shard, no, len(ids), len(at), at[0] if len(at) else None, at[-1] if len(at) else None, np.diff(at) - 1))
            yield pd.DataFrame(out, columns=["shard", "no", "n", "found", "first", "last", "inner"]).astype({"first": "Int64", "last": "Int64"})

    seen = cut_lineage(blocks.select("shard", "no", "payload").mapInPandas(
        run, f"shard {kind}, no bigint, n bigint, found bigint, first bigint, last bigint, inner array<bigint>"))
    slim = seen.drop("inner").withColumn("grp", F.expr(f"no div {GROUP}"))
    in_group = Window.partitionBy("shard", "grp").orderBy("no").rowsBetween(Window.unboundedPreceding, -1)
    local = (slim.withColumn("s", F.coalesce(F.sum("n").over(in_group), F.lit(0)))
             .withColumn("d", F.coalesce(F.sum("found").over(in_group), F.lit(0)))
             .withColumn("e", F.max(F.col("s") + F.col("last")).over(in_group)))
    groups = local.groupBy("shard", "grp").agg(F.sum("n").alias("gn"), F.sum("found").alias("gd"), F.max(F.col("s") + F.col("last")).alias("ge"))
    across = Window.partitionBy("shard").orderBy("grp").rowsBetween(Window.unboundedPreceding, -1)
    groups = (groups.withColumn("gs", F.coalesce(F.sum("gn").over(across), F.lit(0)))
              .withColumn("gb", F.coalesce(F.sum("gd").over(across), F.lit(0)))
              .withColumn("gl", F.max(F.col("gs") + F.col("ge")).over(across)))
    placed = (local.join(groups.select("shard", "grp", "gs", "gb", "gl"), ["shard", "grp"])
              .select("shard", "no", (F.col("gs") + F.col("s")).alias("start"), (F.col("gb") + F.col("d")).alias("before"),
                      F.coalesce(F.greatest("gl", F.col("gs") + F.col("e")), F.lit(-1)).alias("prior")))
    inside = (seen.filter("found > 0").join(placed, ["shard", "no"])
              .select("shard", "before", F.posexplode(F.concat(
                  F.array(F.col("start") + F.col("first") - F.col("prior") - 1), "inner")).alias("k", "n_tokens"))
              .select("shard", (F.col("before") + F.col("k")).alias("seq"), "n_tokens", F.lit(True).alias("closed")))
    total = groups.groupBy("shard").agg(F.sum("gn").alias("n"), F.sum("gd").alias("seq"), F.max(F.col("gs") + F.col("ge")).alias("last"))
    trailing = (total.withColumn("n_tokens", F.col("n") - F.coalesce(F.col("last"), F.lit(-1)) - 1).filter("n_tokens > 0")
                .select("shard", "seq", "n_tokens", F.lit(False).alias("closed")))
    return inside.unionByName(trailing)


def token_counts(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY,
                 separator: int = SEPARATOR, width: int = 2, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id, shard, seq, n_tokens) for every row of ``docs``, by writing its
    token streams under ``folder`` and scanning them."""
    spark = docs.sparkSession
    write_stream(docs, folder, id_col, text_col, vocabulary, separator, width, block_bytes)
    stored = spark.read.schema("shard int, no bigint, payload binary, id string, kind string").parquet(folder)
    lengths = document_lengths(stored.filter("kind = 'block'"), separator, width)
    order = stored.filter("kind = 'doc'").select("shard", F.col("no").alias("seq"), F.col("id").cast(dict(docs.dtypes)[id_col]).alias(id_col))
    return order.join(lengths, ["shard", "seq"]).select(id_col, "shard", "seq", "n_tokens")
