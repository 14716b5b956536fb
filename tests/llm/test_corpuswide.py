"""Operators that look across documents, against brute force."""

import random
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from tidelog.llm import binpack, chat, frames, kdsearch, neardup, sharding
from tidelog.llm import texts as T
from tidelog.llm.components import components

# Near-duplicates


def layers(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", text or "")
    seen, found = Counter(), set()
    for k in range(max(1, len(words) - 4) if words else 0):
        shingle = tuple(words[k : k + 5])
        found.add((shingle, seen[shingle]))
        seen[shingle] += 1
    return found


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def brute_classes(rows):
    sets = {}
    links = []
    for i, text in rows:
        if i is not None:
            sets.setdefault(i, layers(text))
    for a, b in combinations(sorted(sets), 2):
        if sets[a] and sets[b]:
            common = len(sets[a] & sets[b])
            if 9 * common >= 4 * (len(sets[a]) + len(sets[b])):
                links.append((a, b))
    return roots(sets, links)


def near_copies(seed, groups, size):
    rng = random.Random(seed)
    words = [f"t{i}" for i in range(3000)]
    rows, number = [], 1000
    for _ in range(groups):
        base = [rng.choice(words) for _ in range(150)]
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.randint(0, 6)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((number, " ".join(copy)))
            number += 1
    rng.shuffle(rows)
    return rows


def test_classes_are_those_of_all_pairs(odd_rows, make_docs):
    rows = [*odd_rows, *near_copies(1, 4, 30)]
    want = brute_classes(rows)
    found = neardup.classes(make_docs(rows)).collect()
    assert len(found) == len(rows)
    assert {(r.doc_id, r.class_id) for r in found} == {(i, None if i is None else want[i]) for i, _ in rows}


@pytest.mark.parametrize("most", [1 << 28, 1])
def test_rows_that_a_join_would_drop_are_left_out_ahead(spark, monkeypatch, most):
    monkeypatch.setattr(frames, "MOST_MARKS", most)
    ids = [*range(-3000, 60_000, 3), None, 9, 9, 1 << 62]
    rows = spark.createDataFrame([(i, str(i)) for i in ids], "id bigint, bit_ string")
    wanted = spark.createDataFrame([(i,) for i in [*range(0, 60_000, 30), 9, 9, -1, 1 << 62]], "id bigint")
    found = frames.among(rows, "id", wanted)
    assert found.columns == rows.columns
    asked = {r.id for r in wanted.collect()}
    got = [tuple(r) for r in found.collect()]
    assert Counter(r for r in got if r[0] in asked) == Counter((i, str(i)) for i in ids if i in asked)
    others = sum(i not in asked for i in ids)
    assert sum(r[0] not in asked for r in got) < others / (8 if most > 1 else 1)
    assert frames.among(rows, "id", wanted.where("id is null")).count() == 0


def test_one_of_each_class_stays(odd_rows, make_docs):
    rows = [*odd_rows, *near_copies(2, 2, 10)]
    docs = make_docs(rows)
    kept = neardup.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    known = [i for i in ids if i is not None]
    assert sorted(known) == sorted(set(brute_classes(rows).values()))
    assert ids.count(None) == 2


def test_repeated_ids_with_other_words_are_kept(spark):
    rng = random.Random(8)
    a, b, c, d = (" ".join(rng.choice("abcdefgh") * 3 + str(rng.randrange(90)) for _ in range(60)) for _ in range(4))
    rows = [(1, a), (1, b), (2, c), (0, a + " more"), (1, a), (2, c + "  "), (7, d), (7, d), (3, None), (3, ""), (4, "  ")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 keep_id", "2 words_key")
    kept = sorted((r.doc_id, r.text or "") for r in neardup.one_of_each(docs).collect())
    assert [i for i, _ in kept] == [0, 1, 2, 3, 3, 4, 7] and (0, a + " more") in kept and (1, b) in kept
    found = {}
    for r in neardup.classes(docs).collect():
        found.setdefault(r.doc_id, set()).add(r.class_id)
    assert found[0] < found[1] and len(found[1]) == 2 and found[2] == {2} and found[7] == {7}
    clash = spark.createDataFrame([(1, a), (1, b)], "doc_id bigint, text string")
    names = {r.class_id for r in neardup.classes(clash).collect()}
    assert len(names) == 2 and 1 in names and min(names) < 0
    assert neardup.one_of_each(clash).count() == 2


def test_signatures_agree_as_often_as_texts_are_alike():
    rows = near_copies(3, 60, 2)
    texts = [t for _, t in sorted(rows)]
    value, ends, _ = neardup.items(T.plain(pa.array(texts)))
    found = neardup.signatures(value, ends, 100)
    assert (found != neardup.EMPTY).all()
    agree = [(found[k] == found[k + 1]).mean() for k in range(0, len(texts), 2)]
    alike = [
        len(layers(texts[k]) & layers(texts[k + 1])) / len(layers(texts[k]) | layers(texts[k + 1]))
        for k in range(0, len(texts), 2)
    ]
    assert np.mean(agree) == pytest.approx(np.mean(alike), abs=0.02)


def test_components(spark):
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1060)]
    nodes = {n for pair in links for n in pair}
    want = roots(nodes, links)
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert {n: found.get(n, n) for n in nodes} == want


def test_no_documents(no_docs):
    assert neardup.classes(no_docs).count() == 0
    assert neardup.one_of_each(no_docs).count() == 0
    assert sharding.sharded(no_docs).count() == 0


# Sharding


def test_shards(odd_docs, odd_rows):
    found = sharding.sharded(odd_docs, shards=7).collect()
    want = [(i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in odd_rows]
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in found), key=repr) == sorted(want, key=repr)
    sizes = Counter(r.shard for r in found)
    assert max(sizes.values()) - min(sizes.get(s, 0) for s in range(7)) <= 1
    for shard, size in sizes.items():
        assert sorted(r.slot for r in found if r.shard == shard) == list(range(size))
    assert {(r.law, r.grown_shard) for r in found} == {("rows", None)}


def test_matrix_adds_up_and_follows_the_law():
    matrix = np.array(sharding.communication_matrix([100, 0, 37, 5000, 12], 7, 3))
    assert matrix.sum(axis=1).tolist() == [100, 0, 37, 5000, 12]
    assert matrix.sum(axis=0).max() - matrix.sum(axis=0).min() <= 1
    from math import comb

    rng = random.Random(1)
    drawn = Counter(sharding.hypergeometric(rng, 7, 5, 6) for _ in range(20_000))
    for k in range(1, 7):
        assert drawn[k] / 20_000 == pytest.approx(comb(7, k) * comb(5, 6 - k) / comb(12, 6), abs=0.015)


# Packing


def test_packings_hold_all_items_within_the_bound():
    rng = np.random.default_rng(1)
    for trial in range(25):
        room = [10, 50, 200, 2048][trial % 4]
        sizes = np.clip(rng.lognormal(np.log(room * 0.25), 1, 400).astype(int) + 1, 1, room)
        counts = np.bincount(sizes, minlength=room + 1)
        packing, held = binpack.pack(counts), np.zeros_like(counts)
        for bins, filling in packing:
            assert bins > 0 and sum(s * m for s, m in filling) <= room
            for size, many in filling:
                held[size] += bins * many
        assert (held == counts).all()
        assert sum(bins for bins, _ in packing) <= binpack.lower_bound(counts) + 1
    assert binpack.pack(np.zeros(11, int)) == []


def test_small_packings_are_best():
    def fewest(items, room):
        best = len(items)

        def place(k, bins):
            nonlocal best
            if len(bins) >= best:
                return
            if k == len(items):
                best = len(bins)
                return
            for b in {x: i for i, x in enumerate(bins)}.values():
                if bins[b] + items[k] <= room:
                    place(k + 1, [x + items[k] if i == b else x for i, x in enumerate(bins)])
            place(k + 1, [*bins, items[k]])

        place(0, [])
        return best

    rng = random.Random(2)
    exact = 0
    for _ in range(40):
        items = sorted((rng.randint(2, 9) for _ in range(9)), reverse=True)
        packing = binpack.pack(np.bincount(items, minlength=13))
        best = fewest(items, 12)
        got = sum(bins for bins, _ in packing)
        assert best <= got <= best + 1
        exact += got == best
    assert exact >= 38


def test_all_undominated_fillings_are_listed():
    def listed(sizes, room):
        return [filling for _, filling in binpack.fillings(np.bincount(sizes, minlength=room + 1), room)]

    pairs = [((500, 1), (260, 1), (240, 1)), ((500, 1), (300, 1), (200, 1))]
    assert sorted(listed([500, 300, 260, 240, 200], 1000)) == pairs
    assert listed([600, 599, 400], 1000) == [((600, 1), (400, 1))]


def test_searches_that_end_give_the_fewest_bins():
    def fewest(items, room):
        best = len(items)

        def place(k, rooms):
            nonlocal best
            if len(rooms) >= best:
                return
            if k == len(items):
                best = len(rooms)
                return
            for rest in {r for r in rooms if r >= items[k]}:
                at = rooms.index(rest)
                place(k + 1, [*rooms[:at], rest - items[k], *rooms[at + 1 :]])
            place(k + 1, [*rooms, room - items[k]])

        place(0, [])
        return best

    cases = [
        ([46, 25, 24, 22, 21, 21, 20, 17, 17, 16, 15, 11, 9], 55),
        ([32, 30, 22, 21, 11, 7, 7, 5, 3], 47),
        ([49, 23, 21, 21, 19, 19, 14, 10, 10, 6], 49),
    ]
    rng = random.Random(4)
    for _ in range(300):
        room = rng.randint(8, 60)
        cases.append((sorted((rng.randint(max(1, room // 6), room // 2) for _ in range(11)), reverse=True), room))
    for items, room in cases:
        packing = binpack.pack(np.bincount(items, minlength=room + 1))
        assert sum(bins for bins, _ in packing) == fewest(items, room), (items, room)


# Exact top-k


def test_search_is_that_of_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(kdsearch, "SHARD_ROWS", 60)
    monkeypatch.setattr(kdsearch, "BLOCK_ROWS", 4)
    rng = np.random.default_rng(3)
    rows = [(i, (rng.integers(-3, 4, 4) / 16).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[7][1]) for i in range(40)]
    rows += [(2000, None), (2100, [0.5, None, 1.0, 1.0]), (2200, [float("nan"), 0.0, 0.0, 0.0]), (2300, [float("inf"), 0.0, 0.0, 0.0])]
    rows += [(None, [1.0, 1.0, 1.0, 1.0]), (3, rows[3][1]), (2400, [0.25, 0.5])]
    rows += [(5, [9.0, -9.0, 9.0, -9.0]), (5, [-9.0, 9.0, 9.0, 9.0]), (100, [9.0, 9.0, -9.0, 9.0]), (2400, [0.5, 0.5])]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").selectExpr("*", "1 shard", "2 v")
    found = kdsearch.top_inner_products(vectors, every=100, k=10).collect()
    known = [
        (i, np.floor(1024 * np.array(v, float)).astype(int))
        for i, v in rows
        if i is not None and v is not None and None not in v and np.isfinite(v).all()
    ]
    want = []
    for own, (q, asked) in enumerate(known):
        if q % 100 == 0:
            scores = [
                (-int(asked @ v), c) for row, (c, v) in enumerate(known) if row != own and len(v) == len(asked)
            ]
            want += [(q, k + 1, c, -s) for k, (s, c) in enumerate(sorted(scores)[:10])]
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found) == sorted(want)
    assert kdsearch.top_inner_products(vectors.limit(0), every=100, k=10).count() == 0


def test_tree_propagates_a_known_score():
    rng = np.random.default_rng(5)
    points = rng.integers(-50, 50, (3000, 6))
    tree = kdsearch.Tree.load(kdsearch.Tree.build(np.arange(3000), np.arange(3000) + 7, points).dump())
    query = rng.integers(-50, 50, 6)
    whole = tree.search(query, -1, 10)
    scores = sorted(((int(p @ query), -i) for i, p in enumerate(points)), reverse=True)[:10]
    assert whole == [(s, -i, 7 - i) for s, i in scores]
    assert tree.search(query, -1, 10, whole[4][0]) == [hit for hit in whole if hit[0] >= whole[4][0]][:10]


# Chat


def least_cost(roles):
    """Cheapest repair by search over all choices."""
    ids = [chat._role(r) for r in roles]
    best = {chat.START: 0}
    for role in ids:
        after = {}
        for state, cost in best.items():
            options = [(q, 2 * (q != role)) for q in chat.NEXT[state]]
            options += [(q, 3 + 2 * (q != role)) for b in chat.NEXT[state] for q in chat.NEXT[b]]
            if state != chat.START:
                options.append((state, 1 + 2 * (state != role)))
            for q, c in options:
                after[q] = min(after.get(q, 99), cost + c)
        best = after
    return min(cost + 3 * len(chat.ending(state)) for state, cost in best.items())


def legal(text):
    roles = re.findall(r"<\|(system|user|assistant)\|>\n", text)
    if roles[:1] == ["system"]:
        roles = roles[1:]
    return roles == ["user", "assistant"] * (len(roles) // 2) and roles


@pytest.mark.parametrize("block", [4096, 2])
def test_repairs_cost_least_and_are_legal(spark, monkeypatch, block):
    monkeypatch.setattr(chat, "BLOCK", block)
    rng = random.Random(6)
    names = ["system", "user", "assistant", "User ", "tool", None]
    convs = {i: [rng.choice(names) for _ in range(rng.randint(1, 9))] for i in range(80)}
    rows = [(i, k, role, f"text {i}.{k}") for i, roles in convs.items() for k, role in enumerate(roles)]
    rows += [(None, 0, "user", "x")]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "1 block", "2 cost")
    found = {}
    for r in sorted(chat.formatted(turns).collect(), key=lambda r: (r.conv_id, r.chunk)):
        cost, text, n = found.get(r.conv_id, (0, "", 0))
        found[r.conv_id] = (cost + r.cost, text + r.rendered, n + r.n_turns)
    assert set(found) == set(convs)
    for i, roles in convs.items():
        cost, text, n = found[i]
        assert cost == least_cost(roles) and n == len(roles) and legal(text)
        assert re.findall(r"text (\d+\.\d+)", text) == [f"{i}.{k}" for k in range(len(roles))]
        assert text.count("<|end|>") == len(re.findall(r"<\|(?:system|user|assistant)\|>", text))


def test_odd_turns(spark):
    rows = [(1, None, "user", None), (1, 0, "user", ""), (1, 0, "user", ""), (1, 1, "assistant", "y" * 100_000)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    found = sorted(chat.formatted(turns).collect(), key=lambda r: r.chunk)
    assert sum(r.n_turns for r in found) == 4 and sum(r.n_merged for r in found) == 2
    assert legal("".join(r.rendered for r in found))
    assert chat.formatted(turns.limit(0)).count() == 0


def test_turns_come_in_the_stated_order_in_one_chunk(spark):
    rows = [(1, t, r, f"<{t}>") for t, r in ((0, "assistant"), (-1, "user"), (-5000, "assistant"), (None, "user"), (90_000, "user"))]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(3)
    (found,) = chat.formatted(turns).collect()
    assert found.chunk == 0 and found.n_turns == 5 and found.cost == 3
    assert re.findall(r"<(None|-?\d+)>", found.rendered) == ["None", "-5000", "-1", "0", "90000"]


def test_long_conversations_are_cut_by_place(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK", 10)
    monkeypatch.setattr(chat, "SLICE", 16)
    rng = random.Random(3)
    # equal turns, turns of one number, turns without number, in conversations of many lengths
    rows = [(1, 5, "user", "same")] * 45
    rows += [(2, rng.choice([None, -7, 0, 9_999]), rng.choice(["user", "assistant"]), f"t{k:03}") for k in range(63)]
    rows += [(3 + n, k, "user", f"t{k:03}") for n in range(12) for k in range(n + 1)]
    rows += [(1, 99, "assistant", "end")]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(5)
    found = {}
    for r in sorted(chat.formatted(turns).collect(), key=lambda r: (r.conv_id, r.chunk)):
        found.setdefault(r.conv_id, []).append(r)
    lengths = {c: sum(r[0] == c for r in rows) for c in {r[0] for r in rows}}
    for c, chunks in found.items():
        full, rest = divmod(lengths[c], 10)
        assert [(r.chunk, r.n_turns) for r in chunks] == list(enumerate([10] * full + [rest] * (rest > 0)))
        text = "".join(r.rendered for r in chunks)
        wanted = sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        assert re.findall(r"same|t\d{3}|end(?!\|)", text) == [r[3] for r in wanted] and legal(text)
        assert sum(r.cost for r in chunks) == least_cost([r[2] for r in wanted])
    assert set(found) == set(lengths)
