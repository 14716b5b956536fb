"""A uniform shuffle of documents into shards of exact sizes.

Rows lie in partitions. How many rows of each partition go to each shard is drawn as a
uniform permutation of all rows would have it: partition by partition from the
multivariate hypergeometric law over the room that the shards have left, so rows and
columns of the matrix add up exactly. Each partition permutes its rows and cuts them by its
line of the matrix; after the exchange each shard permutes again.
"""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.frames import ranked, written_table

SHARDS, SEED = 40, 20_240_101
#: Rows that one permuting task takes, about, and partitions at least.
PART_ROWS, LEAST_PARTS = 500_000, 32


def hypergeometric(rng: random.Random, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` items, drawn without return, are good.

    Inverts the law over twelve deviations around its mode, outside of which lies less than
    a float can tell.
    """
    if not good or not draws:
        return 0
    if not bad:
        return draws
    total = good + bad
    low, high = max(0, draws - bad), min(draws, good)
    share = good / total
    reach = 12 * (draws * share * (1 - share) * (total - draws) / max(1, total - 1)) ** 0.5 + 12
    mode = min(max((draws + 1) * (good + 1) // (total + 2), low), high)
    first, last = max(low, int(mode - reach)), min(high, int(mode + reach))
    up = np.arange(mode, last, dtype=float)
    up = np.cumprod((good - up) * (draws - up) / ((up + 1) * (bad - draws + up + 1)))
    down = np.arange(mode, first, -1, dtype=float)
    down = np.cumprod(down * (bad - draws + down) / ((good - down + 1) * (draws - down + 1)))
    chance = np.cumsum(np.concatenate([down[::-1], [1.0], up]))
    return first + int(np.searchsorted(chance, rng.random() * chance[-1], "right").clip(0, len(chance) - 1))


def communication_matrix(rows: list[int], shards: int, seed: int) -> list[list[int]]:
    """Counts [partition][shard]: lines add up to ``rows``, columns differ by at most one."""
    rng, total = random.Random(seed), sum(rows)
    left = [total // shards + (shard < total % shards) for shard in range(shards)]
    matrix = []
    for size in rows:
        line, rest, room = [], size, sum(left)
        for free in left:
            drawn = hypergeometric(rng, free, room - free, rest)
            line.append(drawn)
            rest, room = rest - drawn, room - free
        left = [free - drawn for free, drawn in zip(left, line, strict=True)]
        matrix.append(line)
    return matrix


def sharded(
    docs: DataFrame, shards: int = SHARDS, seed: int = SEED, id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: id, size, text_crc32, law, shard, slot, grown_shard.

    ``size`` is the UTF-8 bytes of the text (null: none) and 16. Every arrangement of rows
    in shards is as likely as any other; a run with the same seed over the same files gives
    the same one. Repeated rows, also any number of the same row, are rows of their own;
    other columns play no part; an empty table gives an empty table.
    """
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    parts = LEAST_PARTS + docs.count() // PART_ROWS
    found = docs.select(
        F.col(id_col).alias("id_"),
        (F.octet_length(body) + 16).cast("bigint").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.monotonically_increasing_id().alias("row_"),
    )
    stored = written_table(
        found.withColumn("from_", F.pmod(F.xxhash64(F.lit(seed), "row_"), F.lit(parts)).cast("int")), "unsharded"
    )
    sizes = {row["from_"]: row["count"] for row in stored.groupBy("from_").count().collect()}
    matrix = communication_matrix([sizes.get(part, 0) for part in range(parts)], shards, seed)
    bounds = docs.sparkSession.createDataFrame(
        [(part, np.cumsum(line).tolist()) for part, line in enumerate(matrix)], "from_ int, bounds_ array<bigint>"
    )
    key = F.xxhash64(F.lit(seed + 1), "row_")
    split = F.pmod(F.xxhash64(F.lit(seed + 2), "row_"), F.lit(4))
    local = ranked(stored, ["from_"], [key, F.col("row_")], split, 4, "place_")
    sent = local.join(bounds, "from_").select(
        "id_", "size", "text_crc32", "row_", F.size(F.filter("bounds_", lambda b: b <= F.col("place_"))).alias("shard")
    )
    again = F.xxhash64(F.lit(seed + 3), "row_")
    pieces = 8 + parts // shards
    slots = ranked(
        written_table(sent, "sharded"),
        ["shard"],
        [again, F.col("row_")],
        F.pmod(F.xxhash64(F.lit(seed + 4), "row_"), F.lit(pieces)),
        pieces,
        "slot",
    )
    return slots.select(
        F.col("id_").alias(id_col),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
