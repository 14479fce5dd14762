"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boardsmith.session import ensure_checkpoint_dir, ship_package

# White space that separates words (space and \x09-\x0D), as a regular expression and as characters.
WORD_GAP = r"[\x20\x09-\x0D]+"
WORD_GAP_CHARS = " \t\n\x0b\x0c\r"


def prepare(spark: SparkSession) -> None:
    """Make this package importable in Python workers and the shared checkpoint folder known."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have yet (case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        free = f"__{name}"
        while free.lower() in taken:
            free += "_"
        taken.add(free.lower())
        out.append(free)
    return out


def words_of(text: Column) -> Column:
    """The words of ``text`` (maximal runs of other characters than ``WORD_GAP``); empty for null or blank text."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(WORD_GAP_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WORD_GAP, -1))


def sha256_hex(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
