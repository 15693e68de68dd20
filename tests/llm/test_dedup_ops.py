"""Operators 4, 6 and 7 against brute force."""

import collections
import random
import re

import numpy as np
import pytest

from recoengine.llm import _groups, jaccard_join, substring_dedup, suffix_dedup

LAST = _groups.LAST_ID
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def expected_words(rows, window=13):
    first = {}
    for d, t in rows:
        w = WORD.findall(t or "")
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            first[key] = min(first.get(key, d), d)
    out = []
    for d, t in rows:
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < d:
                gone[i : i + window] = [True] * window
        out.append((d, len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return sorted(out)


def expected_bytes(rows, length=50):
    first = {}
    for d, t in rows:
        raw = (t or "").encode()
        for i in range(len(raw) - length + 1):
            key = raw[i : i + length]
            first[key] = min(first.get(key, d), d)
    out = []
    for d, t in rows:
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - length + 1):
            if first[raw[i : i + length]] < d:
                gone[i : i + length] = True
        spans = [(m.start(), m.end()) for m in re.finditer("1+", "".join("1" if g else "0" for g in gone))]
        out.append((d, len(raw), spans, bytes(np.frombuffer(raw, np.uint8)[~gone])))
    return sorted(out)


def expected_classes(rows, percent=80, k=5):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    nodes = collections.defaultdict(list)
    out = []
    for d, t in rows:
        w = WORD.findall((t or "").translate(fold))
        s = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())
        nodes[d].append(s)
        out.append((d, len(s)))
    parent = {d: d for d in nodes}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in nodes:
        for b in nodes:
            if a < b and any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in nodes[a] for y in nodes[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return sorted((d, n, find(d)) for d, n in out)


@pytest.mark.parametrize("group_bytes", [None, 4000])
def test_repeated_phrases_match_brute_force(docs, rows_of_text, monkeypatch, group_bytes):
    monkeypatch.setattr(_groups.group_texts, "__defaults__", (group_bytes, "doc_id", "text"))
    got = sorted(tuple(r) for r in substring_dedup.remove_repeats(docs).collect())
    assert got == expected_words(rows_of_text)


@pytest.mark.parametrize("group_bytes", [None, 4000])
def test_repeated_bytes_match_brute_force(docs, rows_of_text, monkeypatch, group_bytes):
    monkeypatch.setattr(_groups.group_texts, "__defaults__", (group_bytes, "doc_id", "text"))
    got = sorted((r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in suffix_dedup.remove_repeated_bytes(docs).collect())
    assert got == expected_bytes(rows_of_text)


def test_array_in_more_buckets_than_the_keys(docs, rows_of_text, monkeypatch):
    """The array's buckets were those of the keys, 48 up to 12 GB of text."""
    monkeypatch.setattr(_groups.group_texts, "__defaults__", (4000, "doc_id", "text"))
    monkeypatch.setattr(suffix_dedup, "SORTED_BYTES", 256)
    asked, sampled = [], suffix_dedup.sampled_splitters
    monkeypatch.setattr(suffix_dedup, "sampled_splitters", lambda docs, n, buckets, *more: asked.append(buckets) or sampled(docs, n, buckets, *more))
    got = sorted((r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in suffix_dedup.remove_repeated_bytes(docs).collect())
    assert got == expected_bytes(rows_of_text) and asked[0] > 2 * _groups.group_texts(docs).n_buckets


def test_keys_travel_as_steps():
    for n in (0, 1, 2, 15_000):
        keys = np.unique(np.random.default_rng(n).integers(0, 1 << 32, n, dtype=np.uint64)).astype("<u4")
        data = _groups.packed_rising(keys)
        assert np.array_equal(_groups.unpacked_rising(data), keys) and len(data) <= 3 * n + 100
    edge = np.array([0, 1, 2**32 - 1], "<u4")
    assert np.array_equal(_groups.unpacked_rising(_groups.packed_rising(edge)), edge)


@pytest.mark.parametrize(("group_bytes", "tile_rows"), [(None, 2000), (4000, 3)])
def test_jaccard_classes_match_brute_force(docs, rows_of_text, monkeypatch, group_bytes, tile_rows):
    monkeypatch.setattr(_groups.group_texts, "__defaults__", (group_bytes, "doc_id", "text"))
    got = sorted(tuple(r) for r in jaccard_join.near_duplicates(docs, tile_rows=tile_rows).collect())
    assert got == expected_classes(rows_of_text)


def test_hot_copies_are_set_apart_and_still_answered(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(i, text) for i in range(100)] + [(200, "other " + text), (201, "short one"), (None, text), (None, "alone")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert _groups.group_texts(docs).copies.count() == 100
    got = {r.doc_id: r for r in substring_dedup.remove_repeats(docs).collect() if r.doc_id is not None}
    assert [got[i].n_removed for i in (0, 1, 99, 200, 201)] == [0, 40, 40, 40, 0]
    nulls = sorted((r.n_words, r.n_removed) for r in substring_dedup.remove_repeats(docs).filter("doc_id is null").collect())
    assert nulls == [(1, 0), (40, 40)]
    classes = {r.doc_id: r.component_id for r in jaccard_join.near_duplicates(docs).collect() if r.doc_id is not None}
    assert {classes[i] for i in range(100)} == {0} and classes[200] == 0 and classes[201] == 201
    assert sorted(r.doc_id for r in jaccard_join.keep_one(docs.filter("doc_id is not null")).collect()) == [0, 201]
    raw = {r.doc_id: r for r in suffix_dedup.remove_repeated_bytes(docs).collect()}
    assert len(raw[99].kept) == 0 and bytes(raw[200].kept) == b"other "


@pytest.mark.parametrize("shared_id", [None, 5])
def test_hot_copies_that_share_an_id_are_spread(spark, monkeypatch, shared_id):
    """A third of all rows are one text under one id, or under none."""
    monkeypatch.setattr(_groups.group_texts, "__defaults__", (4000, "doc_id", "text"))
    rng = random.Random(8)
    noise = lambda n: " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(n))
    text, passage = noise(40), noise(20)
    text = f"{text} {passage}"
    rows = [(shared_id, text)] * 400 + [(10 + i, noise(12)) for i in range(780)]
    rows += [(1, f"{noise(9)} {passage} {noise(9)}"), (900, f"{text} more"), (901, f"{noise(30)} {passage}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(16)
    grouped = _groups.group_texts(docs)
    assert grouped.copies.count() == 0
    sizes = [r["count"] for r in grouped.texts.filter(grouped.texts.text == text).groupBy("grp").count().collect()]
    assert sum(sizes) == 400 and len(sizes) > 8 and max(sizes) < 120
    filled = [(LAST if d is None else d, t) for d, t in rows]
    back = lambda d: LAST if d is None else d
    got = sorted((back(r.doc_id), r.n_words, r.n_removed, r.kept) for r in substring_dedup.remove_repeats(docs).collect())
    assert got == expected_words(filled)
    got = sorted((back(r.doc_id), r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in suffix_dedup.remove_repeated_bytes(docs).collect())
    assert got == expected_bytes(filled)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(docs).collect() if r.doc_id is not None)
    known = [r for r in rows if r[0] is not None]
    near = {5: 5, 900: 5} if shared_id else {}
    assert got == sorted((d, len(t.split()) - 4, near.get(d, d)) for d, t in known)


@pytest.mark.parametrize("group_bytes", [None, 500])
def test_equal_ids_with_different_texts(spark, monkeypatch, group_bytes):
    monkeypatch.setattr(_groups.group_texts, "__defaults__", (group_bytes, "doc_id", "text"))
    rng = random.Random(4)
    noise = lambda n: " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(n))
    shared, other = noise(30), noise(25)
    rows = [(1, f"{noise(20)} {shared} {noise(30)}"), (9, f"{other} {noise(9)} {shared}")]
    rows += [(5, f"{noise(40 + i)} {shared if i % 3 == 0 else other if i % 3 == 1 else noise(22)} {noise(20)}") for i in range(12)]
    rows += [(5, rows[2][1]), (7, f"{other} {other}"), (7, other), (9, noise(70)), (9, rows[1][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in suffix_dedup.remove_repeated_bytes(docs).collect())
    assert got == expected_bytes(rows)
    assert sorted(tuple(r) for r in substring_dedup.remove_repeats(docs).collect()) == expected_words(rows)
    assert sorted(tuple(r) for r in jaccard_join.near_duplicates(docs).collect()) == expected_classes(rows)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert substring_dedup.remove_repeats(empty).count() == 0
    assert suffix_dedup.remove_repeated_bytes(empty).count() == 0
    assert jaccard_join.near_duplicates(empty).count() == 0
    assert jaccard_join.keep_one(empty).count() == 0


def test_multikey_order_sorts_like_bytes():
    rng = np.random.default_rng(1)
    for n in (0, 1, 5, 500, 4000):
        rows = rng.integers(0, 3, (n, 21)).astype(np.uint8)
        rows[n // 5 : n // 2] = rows[: n // 2 - n // 5]
        rows[n // 2 :, : rng.integers(8, 21)] = 1
        order = suffix_dedup.multikey_order(rows)
        assert sorted(order.tolist()) == list(range(n))
        assert [rows[i].tobytes() for i in order] == sorted(r.tobytes() for r in rows)


def test_blocks_search_like_all_pairs():
    rng = np.random.default_rng(5)
    rule = jaccard_join.Rule(80)
    for turn in range(30):
        base = [rng.choice(400, rng.integers(1, 60), replace=False) for _ in range(4)]
        sets = []
        for _ in range(40):
            s = set(base[rng.integers(4)].tolist())
            for _ in range(rng.integers(0, 5)):
                s.symmetric_difference_update({int(rng.integers(400))})
            sets.append(np.array(sorted(s or {1})))
        sets.sort(key=len)
        side = rng.integers(0, 2, len(sets)).tolist()
        for both in (False, True):
            parent = list(range(len(sets)))

            def find(a, parent=parent):
                while parent[a] != a:
                    a = parent[a]
                return a

            for i in range(len(sets)):
                for j in range(i):
                    n = len(np.intersect1d(sets[i], sets[j]))
                    if (not both or side[i] != side[j]) and rule.linked(n, len(sets[i]), len(sets[j])):
                        x, y = find(i), find(j)
                        parent[max(x, y)] = min(x, y)
            assert jaccard_join.link_block(sets, [len(s) for s in sets], side, both, rule) == [find(i) for i in range(len(sets))], (turn, both)
