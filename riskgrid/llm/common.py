"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskgrid.session import cut_lineage, ensure_checkpoint_dir, shuffle_partitions

# fixed values: the word classes of the result contracts
SPACE_WORD = r"[^\x20\x09-\x0D]+"
ALNUM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

__all__ = ["SPACE_WORD", "ALNUM_WORD", "alnum_words", "cut_lineage", "ensure_checkpoint_dir",
           "free_names", "path_exists", "read_table", "shuffle_partitions", "text_or_empty"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_or_empty(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def alnum_words(text: Column) -> Column:
    """Lower-cased runs of digits, letters and non-ASCII characters.

    ``lower`` also folds non-ASCII capitals; those stay inside the word class,
    so word boundaries are those of an ASCII-only fold.
    """
    return F.regexp_extract_all(F.lower(text), F.lit(ALNUM_WORD), F.lit(0))


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Column names like ``wanted`` that ``df`` does not have, whatever their case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists in the store Spark reads it from."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
