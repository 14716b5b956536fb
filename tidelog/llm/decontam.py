"""Benchmark decontamination: which documents hold runs of words of benchmark items.

Every run of ten words of an item is a pattern (all words of a shorter item are one), searched
by the method of Wu and Manber (see ``wumanber``), lengths apart. Patterns are sent to tasks in
parts of bounded size: a benchmark of ordinary size is one part and one pass over the
documents; a larger one is searched part by part, and the parts' findings are joined by
document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm import texts as T
from tidelog.llm.frames import written_table
from tidelog.llm.pieces import forget
from tidelog.llm.wumanber import Search

WINDOW = 10
#: Bytes of texts that are searched at a time.
SLICE_BYTES = 1 << 20
#: Bytes of distinct patterns and of the ids of their items that one pass over the documents takes.
PART_BYTES = 32 << 20

#: Which bytes are of words: digits, letters and all beyond ASCII; and A-Z as a-z. Fixed values.
WORDY = np.ones(256, bool)
WORDY[:0x80] = False
WORDY[ord("0") : ord("9") + 1] = True
WORDY[ord("A") : ord("Z") + 1] = True
WORDY[ord("a") : ord("z") + 1] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
UPPER_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER_LETTERS = "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

FOUND = "n_words bigint, spans array<struct<start bigint, stop bigint>>, items array<string>"
SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def windows(benchmark: DataFrame, item_id: str, text: str, width: int = WINDOW) -> DataFrame:
    """(pattern, length, item): the distinct runs of ``width`` words of every item.

    ``pattern`` is its words, parted by spaces.
    """
    lowered = F.translate(F.coalesce(F.col(text), F.lit("")), UPPER_LETTERS, LOWER_LETTERS)
    found = F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))
    rows = benchmark.select(F.col(item_id).cast("string").alias("item"), F.explode(F.array(found)).alias("words"))
    length = F.least(F.size("words"), F.lit(width))
    rows = rows.where(F.size("words") > 0).select("item", "words", length.alias("length"))
    begins = F.sequence(F.lit(0), F.size("words") - F.col("length"))
    runs = F.transform(begins, lambda i: F.array_join(F.slice(F.col("words"), i + 1, F.col("length")), " "))
    return rows.select(F.explode(runs).alias("pattern"), "length", "item").distinct()


class Patterns:
    """Patterns of all lengths, the items of each, and their search tables (made in each task's process)."""

    def __init__(self, table: pa.Table):
        self.table = table  # pattern, length, items
        self.searches: list[tuple[Search, np.ndarray]] | None = None

    def __getstate__(self) -> dict:
        return {"table": self.table, "searches": None}

    def prepare(self) -> None:
        """Numbers the words and builds a search for each length."""
        parts = pc.split_pattern(self.table.column("pattern").combine_chunks(), " ")
        words = parts.flatten().dictionary_encode()
        self.words = words.dictionary.cast(pa.large_binary())
        numbers = words.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1
        ends = np.append(0, np.cumsum(self.table.column("length").to_numpy()))
        self.searches = []
        for length in np.unique(np.diff(ends)).tolist():
            rows = np.flatnonzero(np.diff(ends) == length)
            own = numbers[ends[rows][:, None] + np.arange(length)]
            self.searches.append((Search(own), rows))
        lists = self.table.column("items").combine_chunks()
        self.item_ends = lists.offsets.to_numpy()
        self.items = lists.values.to_pylist()

    def numbered(self, values: pa.Array) -> np.ndarray:
        """The number of each distinct word, 0 for a word of no pattern."""
        found = pc.index_in(values, value_set=self.words)
        return found.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64) + 1


def word_edges(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """First word of each text (one entry more), number of each word's value, and the distinct values."""
    ends, data = T.buffers(texts)
    inside = WORDY[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = ends[:-1][ends[:-1] < len(data)]
    begins[edges] = inside[edges]  # a text begins anew
    start = np.flatnonzero(begins)
    begins = begins[inside]  # now by place among the bytes of words
    offsets = np.append(np.flatnonzero(begins), len(begins))
    codes, distinct = T.coded(T.strings(offsets, LOWER[data[inside]]))
    return np.searchsorted(start, ends), codes, distinct


def _searched(texts: pa.Array, patterns: Patterns) -> list[dict]:
    first, codes, distinct = word_edges(texts)
    words = patterns.numbered(distinct)[codes] if len(codes) else np.zeros(0, np.int64)
    starts, stops, numbers = [], [], []
    for search, rows in patterns.searches or ():
        at, pattern = search.occurrences(words)
        inside = np.searchsorted(first, at, "right") == np.searchsorted(first, at + search.length - 1, "right")
        starts.append(at[inside])
        stops.append(at[inside] + search.length)
        numbers.append(rows[pattern[inside]])
    out = [{"n_words": n, "spans": [], "items": []} for n in np.diff(first).tolist()]
    if not starts or not sum(map(len, starts)):
        return out
    start, stop, number = (np.concatenate(parts) for parts in (starts, stops, numbers))
    order = np.argsort(start, kind="stable")
    start, stop, number = start[order], stop[order], number[order]
    owner = np.searchsorted(first, start, "right") - 1
    # runs of hit words: a window opens one if it begins beyond all that its text had before
    reach = np.maximum.accumulate(stop)  # windows of one text end before the next text begins
    opens = np.append(True, (start[1:] > reach[:-1]) | (owner[1:] != owner[:-1]))
    heads = np.flatnonzero(opens)
    closes = reach[np.append(heads[1:], len(start)) - 1]
    for text, a, b in zip(owner[heads].tolist(), start[heads].tolist(), closes.tolist(), strict=True):
        out[text]["spans"].append({"start": a - int(first[text]), "stop": b - int(first[text])})
    pairs = np.unique(np.stack([owner, number], axis=1), axis=0)
    met: dict[int, set[str]] = {}
    for text, pattern in pairs.tolist():
        met.setdefault(text, set()).update(patterns.items[patterns.item_ends[pattern] : patterns.item_ends[pattern + 1]])
    for text, items in met.items():
        out[text]["items"] = sorted(items, key=str.encode)
    return out


def occurrences(text: Column, patterns: Patterns) -> Column:
    """A struct: number of words, runs of hit words (from 0, stop exclusive), and the items that occur."""
    kind = pa.struct([("n_words", pa.int64()), ("spans", SPANS), ("items", pa.list_(pa.string()))])

    @F.arrow_udf(FOUND)
    def search(values: pa.Array) -> pa.Array:
        forget()
        if patterns.searches is None:
            patterns.prepare()
        rows = [row for _, part in T.slices(T.plain(values), SLICE_BYTES) for row in _searched(part, patterns)]
        return pa.array(rows, kind)

    return search(text)


def pattern_parts(
    benchmark: DataFrame, item_id: str, text: str, width: int, part_bytes: int
) -> list[DataFrame]:
    """Tables of the distinct patterns of a benchmark, their lengths and items: each about ``part_bytes``."""
    known = windows(benchmark, item_id, text, width)
    rows = known.groupBy("pattern", "length").agg(F.array_sort(F.collect_list("item")).alias("items"))
    size = F.octet_length("pattern") + F.aggregate("items", F.lit(0), lambda a, i: a + F.octet_length(i)) + 16
    stored = written_table(rows.withColumn("size", size.cast("bigint")), "patterns")
    total = stored.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    parts = 1 if total <= part_bytes else -(-2 * total // part_bytes)
    part = F.pmod(F.xxhash64("pattern"), F.lit(parts))
    return [stored.where(part == number).select("pattern", "length", "items") for number in range(parts)]


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    width: int = WINDOW,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """(id, n_words, spans, items), one row per document.

    Words are runs of letters, digits and characters beyond ASCII, A-Z in lower case. ``spans``
    are the runs of words that lie in occurrences of windows, ``items`` the ids of items of which
    a window occurs, as strings in byte order. Texts are searched whole; null and empty ones
    have no words. Rows of the benchmark without id or words are in no window; rows that
    repeat an item's id are one item. Repeated documents give repeated rows; other columns play
    no part; an empty table gives an empty table.

    A task holds the patterns of one part, ``part_bytes`` at most on average; of each further
    part the documents are read again, and rows are joined by id and a digest of the text.
    """
    known = benchmark.where(F.col(item_id).isNotNull())
    parts = pattern_parts(known, item_id, item_text, width, part_bytes)
    rows = docs.select(F.col(id_col).alias("id_"), F.col(text).alias("text_"))
    if len(parts) == 1:
        found = rows.withColumn("found_", occurrences(F.col("text_"), Patterns(parts[0].toArrow())))
        return found.select(F.col("id_").alias(id_col), "found_.*")
    key = F.sha2(F.coalesce(F.col("text_"), F.lit("")), 256).alias("key_")
    every = None
    for number, part in enumerate(parts):
        scan = rows.withColumn("found_", occurrences(F.col("text_"), Patterns(part.toArrow())))
        found = scan.select("id_", key, "found_.*", F.lit(number).alias("part_"))
        # the first part keeps all rows, so that each is counted
        found = written_table(found if number == 0 else found.where(F.size("spans") > 0), "occurrences")
        every = found if every is None else every.unionByName(found)
    joined = every.groupBy("id_", "key_").agg(
        F.first("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.count_if(F.col("part_") == 0).alias("rows_"),
    )
    copies = F.explode(F.array_repeat(F.lit(0), F.col("rows_").cast("int")))
    again = joined.select("id_", "n_words", "spans", "items", copies)
    return again.select(F.col("id_").alias(id_col), "n_words", _merged(F.col("spans")).alias("spans"), "items")


def _merged(spans: Column) -> Column:
    """Sorted spans, with those that meet as one."""

    @F.arrow_udf("array<struct<start bigint, stop bigint>>")
    def merge(values: pa.Array) -> pa.Array:
        rows = []
        for spans in values.to_pylist():
            done: list[dict] = []
            for span in spans:
                if done and span["start"] <= done[-1]["stop"]:
                    done[-1]["stop"] = max(done[-1]["stop"], span["stop"])
                else:
                    done.append(span)
            rows.append(done)
        return pa.array(rows, SPANS)

    return merge(spans)


def hit_counts(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and a digest of the items for each row of ``contaminated``."""
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["stop"] - s["start"])
    return found.select(
        id_col,
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def oracle(width: int = WINDOW) -> str:
    """The counts in SQL: all runs of words of all documents, joined with those of the items."""
    words = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER_LETTERS}', '{LOWER_LETTERS}'), '{WORD}')"
    return f"""
        WITH b AS (
            SELECT CAST(item_id AS VARCHAR) AS item, {words} AS w FROM benchmark WHERE item_id IS NOT NULL),
        b2 AS (SELECT item, w, least(len(w), {width}) AS size FROM b WHERE len(w) > 0),
        runs AS (
            SELECT DISTINCT item, size, array_to_string(w[i:i + size - 1], ' ') AS run
            FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS i FROM b2)),
        d AS (SELECT row_number() OVER () AS row_id, doc_id, {words} AS w FROM documents),
        places AS (
            SELECT row_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS run
            FROM (
                SELECT row_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
                FROM d CROSS JOIN (SELECT DISTINCT size FROM runs) WHERE len(w) >= size)),
        met AS (SELECT row_id, size, i, item FROM places JOIN runs USING (size, run)),
        hit AS (
            SELECT row_id, count(DISTINCT word) AS n_hit
            FROM (SELECT row_id, unnest(range(i, i + size)) AS word FROM (SELECT DISTINCT row_id, size, i FROM met))
            GROUP BY row_id),
        items AS (
            SELECT row_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
            FROM (SELECT DISTINCT row_id, item FROM met) GROUP BY row_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
               CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN hit USING (row_id) LEFT JOIN items USING (row_id)"""
