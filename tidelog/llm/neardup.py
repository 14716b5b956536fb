"""Near-duplicates by DartMinHash signatures, banded joins and an exact check.

A document is a weighted set: its shingles of five words, weighted by how often they occur.
The weight axis of a shingle is cut in unit layers, and each layer throws darts along the
rank axis at hashed distances, the same darts in every document that reaches this layer.
A document keeps the darts that fall within a rank at which, for its total weight, every
coordinate is likely hit; of each coordinate the earliest dart counts, and where one stays
empty the rank is doubled. Two documents agree in a coordinate with the probability of
their weighted Jaccard similarity, at a cost of the number of shingles and of darts, not of
their product.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm import texts as T
from tidelog.llm.components import components
from tidelog.llm.frames import among, free_name, written_table
from tidelog.llm.pieces import forget

SHINGLE = 5
#: Bytes of texts that are sketched at a time.
SLICE_BYTES = 1 << 20
#: 20 bands of 5: of two documents at similarity 0.8 all bands differ once in 2,800 times.
BANDS, ROWS = 20, 5
#: Least similarity, as a fraction.
LEAST = (4, 5)

U64 = np.uint64
GOLD = U64(0x9E3779B97F4A7C15)
EMPTY = np.iinfo(np.uint64).max


def items(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes | None]]:
    """Layers of shingles of all texts, offsets of the texts, and a key of each text's words.

    A text with fewer words than a shingle has one shingle; one without words none, and no
    key. A shingle's further occurrences are layers with numbers of their own.
    """
    found = T.words(texts)
    hashed = _hashed(found)
    count = np.diff(found.first)
    per = np.where(count > 0, np.maximum(count - SHINGLE + 1, 1), 0)
    at = T.flat_ranges(found.first[:-1], per)
    text = np.repeat(np.arange(len(per)), per)
    stop = found.first[1:][text]
    value = np.zeros(len(at), np.uint64)
    for step in range(SHINGLE):
        here = at + step
        word = np.where(here < stop, hashed[np.minimum(here, len(hashed) - 1)] if len(hashed) else 0, U64(step))
        value = T.mixed(value ^ word) + GOLD
    key = value ^ T.mixed(text)
    order = np.argsort(key, kind="stable")
    again = key[order][1:] == key[order][:-1]
    if again.any():
        head = np.flatnonzero(np.append(True, ~again))
        turn = np.arange(len(key)) - np.repeat(head, np.diff(np.append(head, len(key))))
        layer = np.zeros(len(key), np.int64)
        layer[order] = turn
        more = layer > 0
        value[more] = T.mixed(value[more] + T.mixed(layer[more]))
    return value, np.append(0, np.cumsum(per)), _keys(found, hashed)


def _hashed(found: T.Words) -> np.ndarray:
    """A hash of each word."""
    codes, distinct = T.coded(found.values())
    if not len(codes):
        return np.zeros(0, np.uint64)
    return np.fromiter((xxhash.xxh3_64_intdigest(v) for v in distinct.to_pylist()), np.uint64, len(distinct))[codes]


def _keys(found: T.Words, hashed: np.ndarray) -> list[bytes | None]:
    wire = hashed.astype("<u8")
    return [
        hashlib.md5(wire[a:b]).digest() if b > a else None
        for a, b in zip(found.first[:-1].tolist(), found.first[1:].tolist(), strict=True)
    ]


def keys_of(texts: pa.Array) -> list[bytes | None]:
    """The key of each text's words, as ``items`` gives it."""
    found = T.words(texts)
    return _keys(found, _hashed(found))


def signatures(value: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Earliest dart [text, coordinate] as rank and number in one integer."""
    n = len(ends) - 1
    weight = np.diff(ends)
    best = np.full(n * size, EMPTY, np.uint64)
    reach = np.zeros(n)
    todo = np.flatnonzero(weight > 0)
    reach[todo] = size * (np.log(size) + 2) / weight[todo]
    while len(todo):
        layers = T.flat_ranges(ends[:-1][todo], weight[todo])
        seeds = value[layers]
        owner = np.repeat(todo, weight[todo])
        rank = np.zeros(len(seeds))
        limit = reach[owner]
        throw = 0
        while len(seeds):
            throw += 1
            dart = T.mixed(seeds + U64(throw * int(GOLD) % (1 << 64)))
            share = ((dart >> U64(11)).astype(np.float64) + 0.5) * 2.0**-53
            near = share > np.exp(rank - limit)  # the next distance, -log(share), ends in reach
            seeds, owner, limit, dart = seeds[near], owner[near], limit[near], dart[near]
            rank = rank[near] - np.log(share[near])
            number = T.mixed(dart)
            place = owner * size + (number % U64(size)).astype(np.int64)
            packed = (rank.astype(np.float32).view(np.uint32).astype(np.uint64) << U64(32)) | (number >> U64(32))
            np.minimum.at(best, place, packed)
        empty = (best.reshape(n, size)[todo] == EMPTY).any(axis=1)
        todo = todo[empty]
        reach[todo] *= 2
    return best.reshape(n, size)


def band_keys(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One key for each band of each text."""
    parts = signature.reshape(len(signature), bands, -1)
    key = np.broadcast_to(T.mixed(np.arange(bands)), parts.shape[:2]).copy()
    for row in range(parts.shape[2]):
        key = T.mixed(key ^ parts[:, :, row]) + GOLD
    return key.view(np.int64)


SKETCH = "key binary, bands array<bigint>"


def sketched(text: Column, bands: int = BANDS, rows: int = ROWS) -> Column:
    """A struct of a key of the words (null if there are none) and the band keys."""

    @F.arrow_udf(SKETCH)
    def sketch(values: pa.Array) -> pa.Array:
        forget()
        all_keys, all_bands = [], [np.zeros(0, np.int64)]
        for _, part in T.slices(T.plain(values), SLICE_BYTES):
            value, ends, keys = items(part)
            all_keys += keys
            all_bands.append(band_keys(signatures(value, ends, bands * rows), bands).ravel())
        offsets = np.arange(len(all_keys) + 1, dtype=np.int32) * bands
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(all_bands)))
        return pa.StructArray.from_arrays([pa.array(all_keys, pa.binary()), lists], ["key", "bands"])

    return sketch(text)


def layered(text: Column) -> Column:
    """A struct of the key of the words of ``text`` and its layers: distinct numbers."""

    @F.arrow_udf("key binary, items array<bigint>")
    def layer(values: pa.Array) -> pa.Array:
        all_keys, parts = [], [pa.array([], pa.list_(pa.int64()))]
        for _, part in T.slices(T.plain(values), SLICE_BYTES):
            value, ends, keys = items(part)
            all_keys += keys
            parts.append(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(value.view(np.int64))))
        return pa.StructArray.from_arrays([pa.array(all_keys, pa.binary()), pa.concat_arrays(parts)], ["key", "items"])

    return layer.asNondeterministic()(text)  # so that a filter on the key does not call it once more


def word_key(text: Column) -> Column:
    """The key of the words of ``text``; null if there are none."""

    @F.arrow_udf("binary")
    def keyed(values: pa.Array) -> pa.Array:
        forget()
        return pa.array([key for _, part in T.slices(T.plain(values), SLICE_BYTES) for key in keys_of(part)], pa.binary())

    return keyed(text)


def _alike(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sets are similar enough; b may be in very many pairs."""
    top, bottom = LEAST
    of_b = sets.select(F.col("id").alias("b"), F.col("items").alias("items_b"))
    of_a = sets.select(F.col("id").alias("a"), F.col("items").alias("items_a"))
    both = F.size(F.array_intersect("items_a", "items_b"))
    sizes = F.size("items_a") + F.size("items_b")
    close = pairs.join(of_b, "b").join(of_a, "a")
    return close.where((top + bottom) * both >= top * sizes).select("a", "b")


def _rare_pairs(some: DataFrame, members: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs of one of ``some`` (id) and one of ``members`` (id, own) that may be similar enough.

    Pairs within one component (``own``) are left out, and by a bound that holds for every
    pair at similarity s. With the items of each set in order, rarest first, a pair's first
    common item comes so early that what follows it in either set can make s; what many
    members share comes late unless it is most of a member. Items of one member are no
    one's common item.
    """
    top, bottom = LEAST
    rows = sets.join(members, "id").select("id", "own", F.size("items").alias("n"), F.explode(F.array_distinct("items")).alias("item"))
    rows = written_table(rows, "members")
    often = written_table(rows.groupBy("item").agg(F.count("*").alias("often")), "often")
    place = F.row_number().over(Window.partitionBy("id").orderBy("often", "item"))
    rest = F.col("n") - place + 1
    rare = rows.join(often, "item").withColumn("rest", rest)
    rare = rare.where("often > 1").where(bottom * F.col("rest") >= top * F.col("n"))
    rare = written_table(rare.select("id", "own", "n", "rest", "item"), "rare")
    left = rare.join(some, "id").alias("a")
    right = rare.alias("b")
    near = (
        (F.col("a.own") != F.col("b.own"))
        & ((top + bottom) * F.least("a.rest", "b.rest") >= top * (F.col("a.n") + F.col("b.n")))
    )
    found = left.join(right, (F.col("a.item") == F.col("b.item")) & near)
    return found.select(F.col("a.id").alias("a"), F.col("b.id").alias("b")).distinct()


def _classed(docs: DataFrame, id_col: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Stored tables: (id, key of the words, bands) by row, and (key, class_id) by distinct words."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text).alias("text"))
    sketches = written_table(
        rows.select("id", sketched(F.col("text")).alias("s")).select("id", "s.*"), "sketches"
    )
    known = sketches.where("id is not null and key is not null")
    # ids may repeat with other words, so nodes have numbers of their own
    nodes = known.groupBy("key").agg(F.min("id").alias("least"), F.first("bands").alias("bands"))
    nodes = written_table(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    buckets = nodes.select("node", F.explode(F.array_distinct("bands")).alias("bucket"))
    sizes = buckets.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    sizes = written_table(sizes, "sizes")
    met = written_table(among(buckets, "bucket", sizes).join(sizes, "bucket"), "met")
    # what a group was copied from meets more of it than a copy does
    reach = written_table(met.groupBy("node").agg(F.sum("size").alias("reach")), "reach")
    first = F.max(F.struct("reach", (-F.col("node")).alias("least")))
    centers = met.join(reach, "node").groupBy("bucket").agg((-first["least"]).alias("center"))
    met = written_table(met.join(written_table(centers, "centers"), "bucket"), "met")
    stars = met.where("node != center").select(F.col("node").alias("a"), F.col("center").alias("b"))
    stars = written_table(stars.distinct(), "stars")
    wanted = stars.select(F.col("a").alias("node")).unionByName(stars.select(F.col("b").alias("node"))).distinct()
    wanted = written_table(nodes.select("node", "key", F.col("least").alias("id")).join(wanted, "node"), "wanted")
    # of the texts of a node's least id, those with the node's words
    some = among(rows, "id", wanted)
    texts = some.join(wanted.withColumnRenamed("key", "own_key"), "id").select("node", "own_key", layered(F.col("text")).alias("s"))
    sets = texts.where("s.key = own_key").select(F.col("node").alias("id"), "s.items")
    if known.count() > known.select("id", "key").distinct().count():
        sets = sets.groupBy("id").agg(F.first("items").alias("items"))  # rows that repeat id and words
    sets = written_table(sets, "sets")
    links = written_table(_alike(stars, sets), "alike")
    roots = components(links)

    def rooted(frame: DataFrame, node: str, root: str) -> DataFrame:
        of = roots.select(F.col("node").alias(node), F.col("root").alias(root))
        return frame.join(of, node, "left").withColumn(root, F.coalesce(root, node))

    placed = rooted(rooted(met.where("size > 2"), "node", "own"), "center", "main")
    placed = written_table(placed.select("bucket", "node", "own", "main"), "placed")
    apart = placed.where("own != main")
    if apart.limit(1).count():
        open_ = written_table(apart.select("bucket").distinct(), "open")
        members = placed.join(open_, "bucket").select(F.col("node").alias("id"), "own").distinct()
        some = apart.select(F.col("node").alias("id")).distinct()
        more = _rare_pairs(written_table(some, "apart"), written_table(members, "open-members"), sets)
        more = written_table(more, "rare-pairs")
        ends = more.select(F.col("a").alias("id")).unionByName(more.select(F.col("b").alias("id")))
        roots = components(links.unionByName(_alike(more, among(sets, "id", ends))))
    belongs = written_table(rooted(nodes.select("key", "node", "least"), "node", "class").select("key", "class", "least"), "classes")
    least = belongs.groupBy("class").agg(F.min("least").alias("least"))
    turn = F.row_number().over(Window.partitionBy("least").orderBy("class"))
    # an id names one class; a further class of nothing but taken ids has a negative name
    names = least.select("class", F.when(turn == 1, F.col("least")).otherwise(-1 - F.col("class")).alias("class_id"))
    named = belongs.join(written_table(names, "names"), "class").select("key", "class_id")
    return sketches, written_table(named, "named")


def classes(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, class_id), one row per row of ``docs``: the least id among its near-duplicates.

    Texts with equal words are one node. Every node is compared, exactly, with the node of
    each of its band buckets that meets most others; nodes that this leaves outside of their
    bucket's component are then compared with all members that can be similar enough. Links
    join to components.

    Texts without words (null, empty) are alone; rows without id have no class and take part
    in none. Rows that repeat an id with other words belong to the classes of their words; where two
    classes have the same least id, one of them has a negative number. Texts are taken whole;
    other columns play no part; an empty table gives an empty table.
    """
    sketches, named = _classed(docs, id_col, text)
    found = sketches.select("id", "key").join(named, "key", "left")
    own = F.when(F.col("id").isNotNull(), F.coalesce("class_id", "id"))
    return found.select(F.col("id").alias(id_col), own.alias("class_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each class: of the least id, and of its texts that with the least key.

    Of rows that agree in id and words, any one stays. Rows without id, and texts without words,
    all stay: they are in no class or alone. An empty table gives an empty table.
    """
    sketches, named = _classed(docs, id_col, text)
    first = F.min(F.struct("id", "key"))
    known = sketches.where("id is not null").select("id", "key")
    chosen = known.join(named, "key").groupBy("class_id").agg(first.alias("first"))
    keep_id, keep_key = free_name(docs, "keep_id"), free_name(docs, "keep_key")
    chosen = written_table(chosen.select(F.col("first.id").alias(keep_id), F.col("first.key").alias(keep_key)), "kept")
    words = free_name(docs, "words_key")
    wordless = ~F.coalesce(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(False)) | F.col(id_col).isNull()
    kept = docs.where(~wordless).join(chosen, F.col(id_col).cast("bigint") == F.col(keep_id))
    kept = kept.withColumn(words, word_key(F.col(text))).where(F.col(words) == F.col(keep_key))
    kept = kept.dropDuplicates([keep_id, keep_key]).drop(keep_id, keep_key, words)
    return kept.unionByName(docs.where(wordless))
