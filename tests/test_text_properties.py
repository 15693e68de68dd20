"""Spark text expressions against a plain-Python statement of each rule."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from recoengine.functions.text import similarity_text, title_key, title_key_strict, word_tokens

ALPHABET = st.sampled_from(list("abcXYZ019 _'\".,;:!?-()[]{}\t\n\r\x0b\x0c\xa0éüß"))
TEXTS = st.lists(st.text(alphabet=ALPHABET, max_size=24), min_size=1, max_size=60)


def py_title_key(s):
    return re.sub(r"[^\w\s]", "", s, flags=re.ASCII).strip(" ").lower()


def py_title_key_strict(s):
    return re.sub(r"\s+", " ", re.sub(r"[^a-zA-Z0-9\s]", "", s, flags=re.ASCII).lower(), flags=re.ASCII).strip(" ")


def py_similarity_text(desc, title):
    text = " ".join(x for x in (desc, title) if x is not None).lower()
    return re.sub(r"\s+", " ", re.sub(r"[^a-z0-9\s]", " ", text, flags=re.ASCII), flags=re.ASCII).strip(" ")


def py_word_tokens(s):
    parts = re.split(r"\s+", (s or "").lower(), flags=re.ASCII)
    stripped = [re.sub(r"^[^\w']+|[^\w']+$", "", p, flags=re.ASCII) for p in parts]
    return [p for p in stripped if p]


@settings(max_examples=25, deadline=None)
@given(TEXTS)
def test_text_rules_match_python(spark, texts):
    rows = [(t, texts[(i + 1) % len(texts)]) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "a string, b string")
    got = df.select(
        "a",
        "b",
        title_key("a").alias("k"),
        title_key_strict("a").alias("ks"),
        similarity_text("a", "b").alias("sim"),
        word_tokens("a").alias("toks"),
    ).collect()
    for r in got:
        assert r.k == py_title_key(r.a)
        assert r.ks == py_title_key_strict(r.a)
        assert r.sim == py_similarity_text(r.a, r.b)
        assert r.toks == py_word_tokens(r.a)
