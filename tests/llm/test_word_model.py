"""The word bigram model of the quality rules against Kneser-Ney written down directly."""

import collections
import math
import re

import numpy as np
import pytest

from stayrate.llm import ngram_model, quality_rules, spans, word_model

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_surprise(docs):
    """-log p of every unit of each (text, language), each text without its own bigrams, words and contexts."""
    out = [None] * len(docs)
    for lang in {x or "" for _, x in docs}:
        mine = [(k, WORD.findall(t) + ["</s>"]) for k, (t, x) in enumerate(docs) if (x or "") == lang and t]
        pairs = {k: list(zip(["<s>", *w], w)) for k, w in mine}
        c2 = collections.Counter(g for p in pairs.values() for g in p)
        seen = collections.Counter(w for _, ws in mine for w in ws)
        context, before, freed = collections.Counter(), collections.Counter(), collections.Counter()

        def discounts(counts):
            t = collections.Counter(counts.values())
            y = t[1] / (t[1] + 2 * t[2]) if t[1] + 2 * t[2] else None
            return {k: max(k - (k + 1) * y * t[k + 1] / t[k], 0.1) if t[k] and y is not None else 0.5 * k for k in (1, 2, 3)}

        d2 = discounts(c2)
        for (v, w), n in c2.items():
            context[v] += n
            before[w] += 1
            freed[v] += d2[min(n, 3)]
        d1 = discounts(before)
        total, size = sum(before.values()), len(before) + 1
        f1 = sum(d1[min(n, 3)] for n in before.values())
        for k, p in pairs.items():
            own2, own1 = collections.Counter(p), collections.Counter(w for _, w in p)
            own0 = collections.Counter(v for v, _ in p)
            x = []
            for v, w in p:
                p1 = ((before[w] - d1[min(before[w], 3)] if seen[w] > own1[w] else 0) + f1 / size) / total
                if context[v] > own0[v]:
                    n = c2[v, w]
                    p1 = ((n - d2[min(n, 3)] if n > own2[v, w] else 0) + freed[v] * p1) / context[v]
                x.append(-math.log(p1))
            out[k] = x
    return out


def corpus(n=140, seed=4):
    rnd = np.random.default_rng(seed)
    words = np.array([f"wörd{k}" if k % 5 else f"w{k}," for k in range(400)])
    zipf = 1 / np.arange(1, 401)
    docs = [(" ".join(rnd.choice(words, rnd.integers(1, 200), p=zipf / zipf.sum())), ["en", "de", None][k % 3]) for k in range(n)]
    docs += [("", "en"), (None, "en"), (" \n", "de"), ("only", "xx"), docs[0], docs[0], ("the " * 500, "en")]
    return docs


@pytest.mark.parametrize("chunk, common", [(4_000_000, 1 << 19), (500, 20), (1, 0)])
def test_surprise_equals_the_formulas(spark, monkeypatch, chunk, common):
    monkeypatch.setattr(word_model, "CHUNK_WORDS", chunk)
    monkeypatch.setattr(word_model, "COMMON", max(common, 1))
    monkeypatch.setattr(word_model, "RANGE_GRAMS", 300)  # many ranges; common contexts are split
    if not common:
        monkeypatch.setattr(word_model, "SAMPLE_TEXT", -1)  # no text in the sample: every word is its hash
    docs = corpus()
    df = spark.createDataFrame([(k, *d) for k, d in enumerate(docs)], "doc_id long, text string, lang string").repartition(5)
    got = {r["doc_id"]: r for r in quality_rules.measure(df, ["doc_id"]).select("row.doc_id", "surprise", "best_quarter").collect()}
    for k, x in enumerate(brute_surprise(docs)):
        if x is None:
            assert got[k]["surprise"] is None
        else:
            assert got[k]["surprise"] == pytest.approx(np.mean(x), rel=1e-5)
            quarter = quality_rules.best_quarter(np.array(x), np.array([0, len(x)]))[0]
            assert got[k]["best_quarter"] == pytest.approx(quarter, rel=1e-5)


def test_verdicts_equal_brute_force(spark):
    docs = corpus(200, 5) + [(" ".join(chr(33 + (k * j) % 90) * 3 for j in range(90)), "en") for k in range(3)]
    df = spark.createDataFrame([(k, *d) for k, d in enumerate(docs)], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in quality_rules.judge(df, ["doc_id"], repeat_percent=60).select(
        "row.doc_id", "kept", "base_failed", "low", "high").collect()}
    surprise = brute_surprise(docs)
    passed = collections.defaultdict(list)
    failed = {}
    for k, (t, lang) in enumerate(docs):
        w = WORD.findall(t or "")
        windows = collections.Counter(zip(w, w[1:], w[2:]))
        again = set()
        for i, g in enumerate(zip(w, w[1:], w[2:])):
            again |= {i, i + 1, i + 2} if windows[g] > 1 else set()
        failed[k] = len(w) < 50 or 100 * len(again) > 60 * len(w)
        assert got[k]["base_failed"] == failed[k]
        if not failed[k]:
            passed[lang].append(math.floor(np.mean(surprise[k]) / quality_rules.STEP))
    for k, (t, lang) in enumerate(docs):
        if failed[k]:
            assert not got[k]["kept"]
            continue
        steps = sorted(passed[lang])
        q = [steps[math.ceil(len(steps) * x) - 1] * quality_rules.STEP for x in (0.5, 0.75)]
        spread = max((q[1] - q[0]) / 0.6745, quality_rules.LEAST_SPREAD)
        low, high = q[0] - quality_rules.BELOW * spread, q[0] + quality_rules.ABOVE * spread
        s, best = np.mean(surprise[k]), quality_rules.best_quarter(np.array(surprise[k]), np.array([0, len(surprise[k])]))[0]
        assert got[k]["kept"] == (s >= low and min(s, best) <= high), k
    assert any(not got[k]["kept"] and not failed[k] for k in got) and any(got[k]["kept"] for k in got)


def test_model_agrees_with_the_general_one(spark):
    docs = [(t, "xx") for t, _ in corpus(60, 6) if t]
    df = spark.createDataFrame([(k, *d) for k, d in enumerate(docs)], "doc_id long, text string, lang string")
    model = ngram_model.fit(df, 2, "text", "lang", ngram_model.WORDS, singles=False)
    import pyarrow as pa
    units, offs = ngram_model.word_units(*spans.text_buffer(pa.array([t for t, _ in docs])))
    want = -ngram_model.Scorer(model).text_scores(units, offs, ["xx"] * len(docs))
    got = {r["doc_id"]: r["surprise"] for r in quality_rules.measure(df, ["doc_id"]).select("row.doc_id", "surprise").collect()}
    assert [got[k] for k in range(len(docs))] == pytest.approx(want.tolist(), rel=1e-4)


def test_blocks_round_trip():
    rng = np.random.default_rng(7)
    a = np.sort(rng.integers(0, 50, 1000).astype(np.uint64))
    a[-5:] = word_model.RARE + np.arange(5, dtype=np.uint64)
    b = rng.integers(0, 2 ** 64, 1000, dtype=np.uint64)
    order = np.lexsort((b, a))
    n = rng.integers(1, 2 ** 32, 1000, dtype=np.uint64).astype(np.uint32)
    for got, want in zip(word_model.unpack_grams(word_model.pack_grams(a[order], b[order], n)), (a[order], b[order], n)):
        assert np.array_equal(got, want)
    none = np.empty(0, np.uint64)
    assert all(len(x) == 0 for x in word_model.unpack_grams(word_model.pack_grams(none, none, none)))
    words = np.unique(b)
    got = word_model.unpack_words(word_model.pack_words(words, n[:len(words)]), np.uint32)
    assert np.array_equal(got[0], words) and np.array_equal(got[1], n[:len(words)])


def test_texts_without_words(spark):
    rows = [(k, None if k % 2 else "", "en") for k in range(10)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = quality_rules.measure(df, ["doc_id"]).collect()
    assert len(got) == 10 and all(r["surprise"] is None and r["n_words"] == 0 for r in got)
    some = spark.createDataFrame([*rows, (20, " ", "de"), (21, "one", "fr")], "doc_id long, text string, lang string")
    assert sum(r["surprise"] is not None for r in quality_rules.measure(some, ["doc_id"]).collect()) == 2
