"""Spelling variants against brute force, long words and awkward tables."""

import collections
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from stayrate.llm import queries, spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def lower(word):
    return re.sub("[A-Z]+", lambda m: m.group().lower(), word)


def brute_words(docs):
    counts = collections.Counter()
    for doc_id, text in docs:
        for w in RUN.findall(text or ""):
            w = lower(w)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if h % 97 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= 5:
                counts[w] += 1
    return {w: n for w, n in counts.items() if n >= 3}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    i = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[i:] == b[i + 1:]


def brute(docs):
    words = brute_words(docs)
    seen, form = {}, {}
    for w, n in words.items():
        seen[w] = [x for x in words if near(w, x)]
        best = min(seen[w], key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= 2 * n:
            form[w] = best
    out = {}
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out[w] = (w, form.get(w), root, n, len(seen[w]), words.get(form.get(w)))
    return out


def result(df):
    rows = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: r for r in rows}


def small_docs(seed=3):
    """Words over few letters, so that replacements, runs and chains of forms are many."""
    rng = random.Random(seed)
    base = ["".join(rng.choice("aabéß") for _ in range(rng.randint(5, 8))) for _ in range(150)]
    docs = []
    for k in range(120):
        words = []
        for _ in range(60):
            w = rng.choice(base[:10] if rng.random() < 0.5 else base)
            if rng.random() < 0.3:
                i = rng.randrange(len(w))
                w = rng.choice([w[:i] + w[i + 1:], w[:i] + "A" + w[i:], w[:i] + "É" + w[i + 1:], w[:i] + w[i] + w[i:]])
            words.append(w)
        docs.append((k if k % 9 else None, rng.choice([" ", "-", "ā", "—", "1"]).join(words)))
    return docs + [(1, None), (2, ""), (3, "××÷÷× " * 4), docs[0], docs[0]]


def test_runs_and_checksums():
    texts = ["Abé-Āxÿ", "", "À" * 100 + " " + "z" * 70 + "1abcde", "中ßb"]
    raw = "".join(texts).encode()
    offs = np.cumsum([0] + [len(t.encode()) for t in texts])
    data = np.frombuffer(raw, np.uint8)
    starts, ends, text = spelling.runs(data, offs)
    got = [(int(t), raw[s:e].decode()) for s, e, t in zip(starts, ends, text)]
    assert got == [(k, w) for k, t in enumerate(texts) for w in RUN.findall(t)]
    before = np.array([zlib.crc32(f"{t}:".encode()) for t in text], np.uint32)
    assert spelling.run_checksums(data, starts, ends, before).tolist() == [zlib.crc32(f"{t}:{w}".encode()) for t, w in got]


@pytest.mark.parametrize("literal", [64, 6])
def test_variants_against_brute_force(spark, monkeypatch, literal):
    monkeypatch.setattr(spelling, "LITERAL", literal)  # 6: longer prefixes of rotations are hashes
    docs = small_docs()
    want = brute(docs)
    assert len(want) > 100 and sum(r[1] is not None for r in want.values()) > 30
    assert any(r[1] != r[2] and r[1] for r in want.values())  # a chain of forms
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("word", "n", "key", "id", "form")})
    assert result(spelling.spelling_variants(df)) == want
    assert result(spelling.spelling_variants(df.repartition(5))) == want


def test_very_long_words(spark):
    long = "".join(random.Random(1).choice("abc") for _ in range(20_000))
    edge = "abcde" * 13  # 65 code points; its cut has 64
    docs = [(k, " ".join([long] * 2 + [long[:999] + long[1000:], edge, edge[:20] + edge[21:], edge[:9] + "x" + edge[10:]] * 2))
            for k in range(1, 8)]
    want = brute_words(docs)
    got = result(spelling.spelling_variants(spark.createDataFrame(docs, "doc_id long, text string")))
    assert {w: r[3] for w, r in got.items()} == want
    for w, r in got.items():
        assert r[4] == sum(near(w, x) for x in want)


def test_empty_and_null_tables(spark):
    nothing = spark.createDataFrame([], "doc_id long, text string")
    out = spelling.spelling_variants(nothing)
    assert out.count() == 0 and out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    nulls = spark.createDataFrame([(None, None), (1, None), (2, "a b c")], "doc_id long, text string")
    assert spelling.spelling_variants(nulls).count() == 0


def test_registered_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = result(queries.QUERIES["op13_spelling_variants"](spark, SMALL))
    words = brute_words(docs)
    assert {w: r[3] for w, r in got.items()} == words
    some = sorted(words)[::37]
    assert {w: got[w][4] for w in some} == {w: sum(near(w, x) for x in words) for w in some}
