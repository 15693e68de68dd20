"""Operators 11 to 13: lexical search, language identification, periodic runs."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from conftest import LETTERS, words

from recoengine.llm import language_id, lexical_search, periodic_runs
from recoengine.llm.queries import QUERIES

ODD = "doc_id long, text string, item long, score long, term string, lang string, runs int, start long, n_words int, text_key long"


def odd_rows(rows):
    return [(i, t, 1, 2, "x", "zz", 3, 4, 5, 6) for i, t in rows]


# --- periodic runs -------------------------------------------------------


def plain_runs(w, least=12):
    """All maximal repetitions, by comparing the words at every distance."""
    found = []
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(least, 2 * q) and not any(all(w[x] == w[x + p] for x in range(i, i + size - p)) for p in range(1, q)):
                found.append((i, size, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_collapse(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def repeating(rng, n, k):
    w = [rng.randrange(k) for _ in range(n)]
    if n > 10 and rng.random() < 0.5:
        a = rng.randrange(n)
        p = 1 + rng.randrange(max(1, (n - a) // 2))
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def test_runs_equal_plain_comparison():
    rng = random.Random(5)
    for _ in range(400):
        w = repeating(rng, rng.randint(0, 80), rng.choice((1, 2, 3, 6)))
        for least in (2, 7, 12):
            expected = plain_runs(w, least)
            assert [tuple(r) for r in periodic_runs.runs_of(w, least).tolist()] == expected
            hashes = np.array([x * 7919 + 1 for x in w], np.uint64)
            covered = periodic_runs.covered_words(hashes, np.array([0, len(w)]), (least + 1) // 2)
            own = periodic_runs.text_runs([b"%d" % x for x in w], covered, least) if covered.any() else np.zeros((0, 3))
            assert [tuple(r) for r in own.tolist()] == expected


def test_constant_time_extension_equals_comparison():
    rng = random.Random(6)
    w = repeating(rng, 400, 3)
    extension = periodic_runs.CommonExtension(*periodic_runs.SuffixTree(w).tour()[:2])
    a, b = np.array([(rng.randrange(400), rng.randrange(400)) for _ in range(3000)]).T
    a, b = a[a != b], b[a != b]
    for i, j, n in zip(a.tolist(), b.tolist(), extension(a, b).tolist(), strict=True):
        k = 0
        while max(i, j) + k < 400 and w[i + k] == w[j + k]:
            k += 1
        assert n == k


def test_leaves_in_both_orders():
    rng = random.Random(7)
    w = repeating(rng, 120, 3)
    tree = periodic_runs.SuffixTree(w)
    assert tree.tour()[2] == sorted(range(121), key=lambda i: w[i:])
    assert tree.opposite_order() == sorted(range(121), key=lambda i: [-x for x in w[i:]])


@pytest.fixture(scope="module")
def run_rows():
    rng = random.Random(8)
    rows = [(i, " ".join(f"w{x}" for x in repeating(rng, rng.randint(0, 150), rng.choice((2, 4, 50))))) for i in range(120)]
    rows += [(500, None), (501, ""), (502, " \n\t"), (503, "a " * 30), (504, "same\x0b\x0csame " * 20), (505, "\x1c\x85 é " * 15), (506, "a b " * 20)]
    rows += [(507, " ".join(f"v{i % 700}" for i in range(5000))), rows[3], (None, "x y " * 12), (3, "other " * 13)]
    return rows


def test_periodic_runs_operator(spark, run_rows):
    docs = spark.createDataFrame(odd_rows(run_rows), ODD).repartition(3)
    out = periodic_runs.periodic_runs(docs)
    assert out.columns == ["doc_id", "n_words", "runs", "collapsed"]
    found = collections.Counter((r.doc_id, r.n_words, tuple(tuple(x) for x in r.runs), bytes(r.collapsed)) for r in out.collect())
    expected = collections.Counter()
    for i, t in run_rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        runs = [(0, 5000, 700)] if i == 507 else plain_runs(w)
        expected[i, len(w), tuple(runs), plain_collapse(w, runs).encode()] += 1
    assert found == expected
    assert periodic_runs.periodic_runs(docs.filter("false")).count() == 0


def test_runs_query_on_planted_tails(spark, tmp_path):
    rng = random.Random(9)
    rows = [(i, "\n".join(words(rng, rng.randint(0, 60)))) for i in range(150)] + [(900, None), (901, "  ")]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(2).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r for r in QUERIES["op13_periodic_runs"](spark, str(tmp_path)).collect()}
    assert len(found) == len(rows)
    planted = 0
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        n, h = len(w), zlib.crc32(str(i).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[x] if x < a else w[a + (x - a) % p] for x in range(n)]
            planted += 1
        runs = plain_runs(w)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        r = found[i]
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(plain_collapse(w, runs).encode()).hexdigest()
    assert planted > 5


# --- lexical search ------------------------------------------------------


def plain_search(docs, items, top=10):
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    own = [(d, collections.Counter(terms(t))) for d, t in docs]
    n_docs, length = sum(bool(c) for _, c in own), sum(sum(c.values()) for _, c in own)
    df = collections.Counter(t for _, c in own for t in c)
    rows = []
    for item, text in items:
        scores = []
        for d, c in own:
            m = 25 + 75 * sum(c.values()) * n_docs // max(1, length)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms(text) if t in c)
            if s > 0:
                scores.append((-s, d is None, d or 0))
        rows += [(item, r, None if null else d, -s) for r, (s, null, d) in enumerate(sorted(scores)[:top], 1)]
    return collections.Counter(rows)


@pytest.fixture(scope="module")
def search_rows():
    rng = random.Random(10)
    vocabulary = words(rng, 150) + ["É", "straße", "ÀB", "x" * 40, "Y" * 33, "z" * 32, "𝔘ni", "a b"]
    pick = lambda n: "".join(rng.choice(vocabulary).title() + rng.choice((" ", ", ", "-", "\x00", "\n", "_")) for _ in range(n))
    docs = [(i, pick(rng.choice((0, 1, 5, 40, 300)))) for i in range(90)]
    docs += [(500, None), (501, ""), (502, " ..\x7f"), (503, pick(3000)), docs[5], docs[5], (5, "other text"), (None, docs[7][1])]
    items = [(k, pick(rng.randint(1, 40))) for k in range(25)] + [(100, None), (101, ""), (102, "unheard-of wording"), (3, pick(6)), (None, pick(9)), (103, " ".join(vocabulary) * 2)]
    return docs, items


@pytest.mark.parametrize("block_pairs", [200_000, 300, 64])
def test_search_equals_plain_scores(spark, search_rows, block_pairs):
    docs, items = search_rows
    frame = spark.createDataFrame(odd_rows(docs), ODD).repartition(4)
    bench = spark.createDataFrame([(k, t, 1, 2) for k, t in items], "item_id long, text string, item int, doc_id int").repartition(2)
    out = lexical_search.search(frame, bench, block_pairs=block_pairs)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    assert collections.Counter(map(tuple, out.collect())) == plain_search(docs, items)
    if block_pairs == 300:  # nothing to find, nothing to look in
        assert lexical_search.search(frame, bench.filter("false")).count() == 0
        assert lexical_search.search(frame.filter("false"), bench).count() == 0


def test_long_texts_are_read_in_pieces(monkeypatch):
    monkeypatch.setattr(lexical_search, "PIECE_BYTES", 50)
    rng = random.Random(11)
    vocabulary = words(rng, 30)
    scanner = lexical_search.Scanner([w.encode() for w in set(vocabulary[:10])])
    text = " ".join(rng.choice(vocabulary) for _ in range(4000)).encode()
    n, _, term, times = scanner.count(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    expected = collections.Counter(text.decode().split())
    assert n.tolist() == [4000]
    assert {w: k for w, k in expected.items() if w in vocabulary[:10]} == {list(set(vocabulary[:10]))[t]: k for t, k in zip(term.tolist(), times.tolist(), strict=True)}


# --- language identification ---------------------------------------------


def language_corpus(seed, n, languages):
    """Texts of invented languages: each prefers some syllables."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        k = rng.randrange(languages)
        own = LETTERS[k % len(LETTERS) :] + LETTERS[: k % len(LETTERS)]
        extra = f"{chr(97 + k % 26)}{chr(97 + k * 7 % 26)}"
        text = " ".join("".join(rng.choices([*own[:6], extra], k=rng.randint(1, 4))) for _ in range(rng.choice((6, 30, 120))))
        rows.append((i, text.capitalize(), f"l{k:02d}"))
    return rows


def test_every_learnt_gram_is_contained():
    rng = random.Random(12)
    table = np.zeros((2, language_id.ROWS), np.uint64)
    own = [np.array([rng.getrandbits(64) for _ in range(2000)], np.uint64) for _ in range(70)]
    for k, h in enumerate(own):
        for p in language_id.rows_of(h):
            table[k >> 6, p] |= np.uint64(1) << np.uint64(k & 63)
    filters = language_id.Filters([f"l{k}" for k in range(70)], table, np.ones(70), 0)
    for k, h in enumerate(own):
        assert ((filters.contained(h)[k >> 6] >> np.uint64(k & 63)) & np.uint64(1)).all()
    strangers = np.array([rng.getrandbits(64) for _ in range(20000)], np.uint64)
    yes = ((filters.contained(strangers)[0] >> np.uint64(3)) & np.uint64(1)).mean()
    assert abs(yes - filters.wrong[3]) < 0.01  # the share that is taken off


def test_grams_equal_plain_listing():
    texts = ["Ab cde, É", None, "", "x", "don't STOP 12 ab1cd", "ß" * 5]
    points, begin = language_id.joined(texts)
    found = collections.Counter()
    for text, h in language_id.text_pieces(points, begin):
        found.update(zip(text.tolist(), h.tolist(), strict=True))
    expected = collections.Counter()
    for i, t in enumerate(texts):
        for w in re.findall(r"[^\W\d_]+", (t or "").lower()):
            padded = [0, *map(ord, w), 0]
            for size in language_id.SIZES:
                for k in range(len(padded) - size + 1):
                    with np.errstate(over="ignore"):
                        h = np.uint64(size)
                        for x, step in zip(padded[k : k + size], language_id.STEPS, strict=False):
                            h += np.uint64(x) * step
                        expected[i, int(language_id.mix(np.array([h], np.uint64))[0])] += 1
    assert found == expected


def test_pieces_of_long_texts(monkeypatch):
    texts = [" ".join(words(random.Random(13), 300)), "x", " ".join(words(random.Random(14), 200))]
    whole = sorted(x for t, h in language_id.text_pieces(*language_id.joined(texts)) for x in zip(t.tolist(), h.tolist(), strict=True))
    monkeypatch.setattr(language_id, "PIECE", 37)
    assert sorted(x for t, h in language_id.text_pieces(*language_id.joined(texts)) for x in zip(t.tolist(), h.tolist(), strict=True)) == whole


@pytest.mark.parametrize("languages", [4, 70])
def test_held_out_languages(spark, languages):
    rows = language_corpus(15, 500 * (1 + languages // 35), languages)
    odd = [(9000, None, "l00"), (9001, "", "l01"), (9002, "12 .. €", None), (9003, "ЖЖЖ ЖЖ", None), (None, rows[0][1], rows[0][2]), rows[1]]
    schema = "doc_id long, text string, lang string, score int, held_out int, gram long"
    docs = spark.createDataFrame([(*r, 1, 2, 3) for r in rows + odd], schema).repartition(3)
    filters = language_id.trained_filters(docs)
    assert filters.languages == sorted({x for _, _, x in rows})
    out = language_id.predict(docs, filters).collect()
    assert len(out) == len(rows) + len(odd) and all(0 <= r.score <= 1 for r in out)
    truth = {i: x for i, _, x in rows}
    kept = [r for r in out if r.doc_id in truth and r.held_out]
    assert all(r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    assert sum(r.lang_pred == truth[r.doc_id] for r in kept) >= 0.95 * len(kept) and len(kept) > 50
    found = {r.doc_id: r for r in out}
    assert all((found[i].lang_pred, found[i].score) == ("und", 0.0) for i in (9000, 9001, 9002))
    assert found[9003].lang_pred in filters.languages and found[9003].score == 0
    assert found[None].lang_pred == rows[0][2]


def test_no_labels_no_documents(spark):
    docs = spark.createDataFrame([(1, "some words", None), (2, None, None)], "doc_id long, text string, lang string")
    out = language_id.predict(docs, language_id.trained_filters(docs)).collect()
    assert [(r.lang_pred, r.score) for r in out] == [("und", 0.0)] * 2
    assert language_id.predict(docs.filter("false"), language_id.trained_filters(docs.filter("false"))).count() == 0
