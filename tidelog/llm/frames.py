"""Small helpers on DataFrames that the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.session import written_table


#: Rows go to Python workers and back in batches of about so many bytes.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4MB"


def bounded_batches(spark: SparkSession) -> None:
    """Sets the size of Arrow batches where the session does not: a batch is otherwise 10,000 texts."""
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder, to be worked on in bounded batches."""
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores as it takes to be no column of ``df``."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


#: Marks for each value that is looked for, and the most marks in all (32 MB).
MARKS_EACH, MOST_MARKS = 16, 1 << 28


def among(df: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """``df`` without most rows whose ``column`` (long) is not in ``wanted``, ahead of a join.

    Each wanted value sets one of many marks, kept as bitmaps of 4 KB that are broadcast, so
    rows that a join would drop are not shuffled for it. All rows with a wanted value stay, one in
    sixteen or fewer of the others too; more only where ``wanted`` has over 16 million rows.
    ``wanted`` is read twice: pass a stored table.
    """
    marks = 1 << 15
    while marks < min(MARKS_EACH * wanted.count(), MOST_MARKS):
        marks *= 2
    bits, bit, group = (free_name(df, n) for n in ("bits_", "bit_", "group_"))

    def marked(frame: DataFrame) -> DataFrame:
        mark = F.pmod(F.xxhash64(column), F.lit(marks))
        return frame.withColumn(bit, mark % 32768).withColumn(group, (mark / 32768).cast("int"))

    maps = marked(wanted.select(column)).groupBy(group).agg(F.bitmap_construct_agg(bit).alias(bits))
    octet = F.conv(F.hex(F.substring(bits, (F.col(bit) / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = marked(df).join(F.broadcast(maps), group)
    return found.where(F.getbit(octet, (F.col(bit) % 8).cast("int")) == 1).select(df.columns)


def ranked(df: DataFrame, keys: list[str], order: list[Column], spread: Column, parts: int, name: str) -> DataFrame:
    """Adds ``name``: the place (from 0, without gaps) of each row among the rows of its keys.

    Rows of one key are dealt into ``parts`` parts by ``spread`` (0 to parts - 1, ascending
    with the wanted order or unrelated to it), ranked within a part and moved by the number
    of rows in earlier parts. So a key that holds a third of all rows is many small groups.
    ``df`` is read twice: pass a stored table.
    """
    part, before, count = (free_name(df, n) for n in ("part_", "before_", "count_"))
    dealt = df.withColumn(part, spread.cast("int"))
    sizes = dealt.groupBy(*keys, part).agg(F.count("*").alias(count))
    earlier = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*keys, part, F.coalesce(F.sum(count).over(earlier), F.lit(0)).alias(before))
    within = Window.partitionBy(*keys, part).orderBy(*order)
    return (
        dealt.withColumn(name, F.row_number().over(within) - 1)
        .join(written_table(starts, "starts"), [*keys, part])
        .withColumn(name, (F.col(name) + F.col(before)).cast("bigint"))
        .drop(part, before)
    )


__all__ = ["among", "bounded_batches", "free_name", "ranked", "table", "written_table"]
