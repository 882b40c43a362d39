"""The operators' inner parts against brute force, without Spark."""

import collections
import io
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import xxhash

from stayrate.llm import features, ngram_model, quality_classifier, quality_rules, simhash, spans, token_files, toxicity, warc
from stayrate.llm.components import merge_links
from stayrate.llm.embeddings import spherical_kmeans, visited
from stayrate.llm.packing import plan, reduce_dominated
from stayrate.llm.tokens import CachedEncoder

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [None, "", " ", "a", "a b", "  a  b ", "x\n\ny", "a \nb\t c", " x   y", "it's we'll I'm  'd", "É ä ñ é",
       "tab\tsep  two", "123 45,678 \x1c z", "日本語 テスト", "a" * 5000 + " b", "trail ", "\n", "a b 　 c",
       "🙂 🙂🙂 x", "<|endoftext|> a b<|endoftext|>c", "ONE!! TWO!! | %%% ###", "the cat sat. " * 40, "a b c a b c\na b c\na b c"]


def buffer(texts):
    return spans.text_buffer(pa.array(texts, pa.string()))


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_equal_the_library(name):
    enc = CachedEncoder(public_tokenizers.path(name))
    rnd = random.Random(3)
    texts = ODD + ["".join(rnd.choice(["the ", "Foo", ", ", "\n", " ", "é", "x1", ".", "'s ", " ", "<|", "ß"])
                           for _ in range(rnd.randint(1, 60))) for _ in range(300)]
    for part in (texts, texts[::-1]):
        ids, at = enc.encode_many(*buffer(part))
        for k, t in enumerate(part):
            assert ids[at[k]:at[k + 1]].tolist() == enc.tok.encode(t or "", add_special_tokens=False).ids, t


def test_token_caches_start_anew_when_full(monkeypatch):
    from stayrate.llm import tokens
    monkeypatch.setattr(tokens, "CACHE_SEGMENTS", 5)
    monkeypatch.setattr(tokens, "CACHE_PIECES", 3)
    monkeypatch.setattr(tokens, "FRESH_SEGMENTS", 2)
    enc = CachedEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    for t in [x for x in ODD if x] * 2:
        assert enc.encode(t) == enc.tok.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("n", [0, 1, 1023, 1024, 1025, 5000])
def test_blocks_round_trip(n):
    r = np.random.default_rng(n)
    for ids in (r.integers(0, 50257, n), np.full(n, 7), np.where(r.random(n) < 0.02, 2**32 - 1, r.integers(0, 9, n)),
                np.arange(n) * 65536):
        ids = ids.astype(np.uint32)
        buf = b"".join(token_files.file_bytes(ids, [None, 3], [n, 0]))
        got, keys, lengths = token_files.parse_file(buf)
        assert np.array_equal(got, ids) and keys == [None, 3] and lengths.tolist() == [n, 0]


def test_outliers_go_to_the_exception_list():
    ids = np.arange(1024, dtype=np.uint32) % 16
    ids[5] = 40000
    blocks, _ = token_files.encode_blocks(ids)
    count, low, exceptions, width = np.frombuffer(blocks[0], np.uint32, 4)
    assert (count, low, exceptions, width) == (1024, 0, 1, 4)
    assert len(blocks[0]) == 16 + 1024 * 4 // 8 + 6


def test_a_damaged_token_file_is_refused():
    buf = b"".join(token_files.file_bytes(np.arange(10, dtype=np.uint32), [1], [10]))
    with pytest.raises(ValueError):
        token_files.parse_file(buf[:-1])


def brute_fingerprint(t, n=3):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (t or ""))
    w = WORD.findall(t)
    sh = [" ".join(w[i:i + n]) for i in range(len(w) - n + 1)] if len(w) >= n else ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in sh]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def test_fingerprints():
    assert simhash.fingerprints(*buffer(ODD), 3).tolist() == [brute_fingerprint(t) for t in ODD]


@pytest.mark.parametrize("seed", range(4))
def test_trie_join_finds_exactly_the_connected_keys(seed, monkeypatch):
    if seed % 2:
        monkeypatch.setattr(simhash, "FRONTIER", 64)
        monkeypatch.setattr(simhash, "LEAF", 2)
    r = np.random.default_rng(seed)
    keys = set()
    for b in r.integers(0, 2**63, 30).tolist():
        for _ in range(int(r.integers(1, 40))):
            x = b
            for k in r.choice(64, int(r.integers(0, 5)), replace=False).tolist():
                x ^= 1 << k
            keys.add(x)
    key = np.array(sorted(keys), np.uint64)
    group = np.sort(r.integers(0, 3, len(key)))
    o = np.lexsort((key, group))
    key, group = key[o], group[o]
    near = (np.bitwise_count(key[:, None] ^ key[None]) <= 3) & (group[:, None] == group[None])
    want = np.arange(len(key))
    while True:
        new = np.where(near, want[None], len(key)).min(1)
        if np.array_equal(new, want):
            break
        want = new
    assert np.array_equal(simhash.trie_links(group, key, 3), want)


def test_merge_links_points_at_minima():
    label = np.arange(8)
    merge_links(label, np.array([7, 3, 5]), np.array([3, 1, 6]))
    assert label.tolist() == [0, 1, 2, 1, 4, 5, 5, 1]


def fewest(items, capacity):
    items, best = sorted(items, reverse=True), [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for k in {r: k for k, r in enumerate(bins)}.values():
            if bins[k] + items[i] <= capacity:
                bins[k] += items[i]
                go(i + 1, bins)
                bins[k] -= items[i]
        go(i + 1, bins + [items[i]])

    go(0, [])
    return best[0]


def test_reduction_never_costs_a_sequence_and_plans_are_gapless():
    rnd = random.Random(1)
    worse = 0
    for _ in range(400):
        capacity = rnd.choice([7, 10, 13, 20, 30])
        hist = collections.Counter(rnd.randint(1, capacity) for _ in range(rnd.randint(1, 8)))
        best = fewest(list(hist.elements()), capacity)
        count = np.zeros(capacity + 1, np.int64)
        for x, k in hist.items():
            count[x] = k
        fixed = reduce_dominated(count, capacity)
        rest = [x for x in range(capacity + 1) for _ in range(count[x])]
        assert sum(n for _, n in fixed) + fewest(rest, capacity) == best
        placed, n = plan(hist, capacity)
        worse += n > best
        seen = collections.defaultdict(list)
        for length, (first, sequence, offset) in placed.items():
            assert first[0] == 0
            for f, s, o, e in zip(first, sequence, offset, [*first[1:], hist[length]]):
                for k in range(e - f):
                    seen[int(s) + k].append((int(o), length))
        assert sorted(seen) == list(range(n)) and sum(map(len, seen.values())) == sum(hist.values())
        for pieces in seen.values():
            at = 0
            for o, length in sorted(pieces):
                assert o == at
                at += length
            assert at <= capacity
    assert worse <= 4


def test_plan_of_many_pieces_is_near_the_bound():
    r = np.random.default_rng(0)
    x = np.minimum(2048, r.lognormal(6.3, 0.9, 200_000).astype(int) + 1)
    hist = dict(zip(*[a.tolist() for a in np.unique(x, return_counts=True)]))
    assert plan(hist, 2048)[1] <= math.ceil(x.sum() / 2048) * 1.002
    assert plan({}, 2048) == ({}, 0)


def test_text_counts():
    rnd = random.Random(5)
    texts = ODD + [" ".join(rnd.choice("ab") for _ in range(30)) + "\n" + "x y\nx y\n" * rnd.randint(0, 3) for _ in range(30)]
    got = quality_rules.text_counts(*buffer(texts))
    for k, t in enumerate(texts):
        t = t or ""
        w = WORD.findall(t)
        c = collections.Counter(zip(w, w[1:], w[2:]))
        cover = {k + j for k, g in enumerate(zip(w, w[1:], w[2:])) if c[g] > 1 for j in range(3)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover))
        assert tuple(int(got[x][k]) for x in quality_rules._COUNTS) == want, t


def test_ngram_keys_and_hashes():
    data, offs = buffer(["abc", "", "de"])
    keys = ngram_model.padded_keys(data, offs, 3)
    assert [int(k).to_bytes(3, "big") for k in keys] == [b"\0\0a", b"\0ab", b"abc", b"\0\0d", b"\0de"]
    u, c = ngram_model.count_keys(np.array([5, 2, 5], np.uint64))
    assert u.tolist() == [2, 5] and c.tolist() == [1, 2]


def _member_sizes(data):
    return [len(m) for m in warc.members(io.BytesIO(data))]


def test_warc_reads_member_by_member():
    pages = [(1, "http://a/x y", b"hello"), (None, None, b""), (3, "http://b", bytes(range(256)) * 1000)]
    raw = b"".join(warc.record(i, u, p, None, False) for i, u, p in pages) + warc.record(4, "http://c", b"hello", 1, True)
    got = [warc.parse_record(m) for m in warc.members(io.BytesIO(raw))]
    assert [(g["page_id"], g["payload"], g["payload_bytes"]) for g in got[:3]] == [(i, p, len(p)) for i, _, p in pages]
    assert got[0]["url"] == "http://a/x%20y" and got[1]["url"] is None
    assert (got[3]["record_type"], got[3]["refers_to"], got[3]["payload"], got[3]["payload_bytes"]) == ("revisit", 1, None, 5)
    with pytest.raises(warc.WarcError):
        list(warc.members(io.BytesIO(raw[:-5])))
    one = zlib.decompress(warc.record(1, "u", b"hello", None, False), 31)
    with pytest.raises(warc.WarcError):
        warc.parse_record(one.replace(b"hello", b"jello"))
    with pytest.raises(warc.WarcError):
        warc.parse_record(one[:-2])


def test_ftrl_learns_and_scores_are_sparse_dot_products():
    good = [f"the quick fox number {k} went home again today." for k in range(60)]
    bad = [f"WIN!! CASH!! {k}!! NOW!! | | |" for k in range(60)]
    data, offs = buffer(good + bad + ["", None])
    text, index, x = features.quality_features(data, offs)
    cut = np.searchsorted(text, np.arange(123))
    rows = [(index[a:b], x[a:b]) for a, b in zip(cut, cut[1:])]
    y = np.array([1.0] * 60 + [0.0] * 60)
    w, bias = quality_classifier.ftrl(y, [i for i, _ in rows[:120]], [v for _, v in rows[:120]])
    s = features.dots(data, offs, features.quality_features, w) + bias
    assert s[:60].min() > 0 > s[60:120].max()
    assert s[120] == s[121] == bias
    assert np.allclose(s[:120], [w[i] @ v + bias for i, v in rows[:120]])


def test_ordinal_grades_are_ordered():
    rnd = random.Random(2)
    text = [" ".join(rnd.choice(["tree", "house", "river", "cloud", "stone"]) for _ in range(20)) + " vile" * 0
            + "".join(f" slur{k}" for k in range(g)) for g in [0] * 200 + [1] * 30 + [2] * 30 + [3] * 30]
    grade = np.array([0] * 200 + [1] * 30 + [2] * 30 + [3] * 30)
    data, offs = buffer(text)
    t, index, _ = features.word_presence(data, offs)
    cut = np.searchsorted(t, np.arange(len(text) + 1))
    index = [index[a:b] for a, b in zip(cut, cut[1:])]
    used = toxicity.screen(grade > 0, index)
    index = [i[used[i]] for i in index]
    m = toxicity.fit_ordinal(grade, index, [np.ones(len(i)) for i in index], 3)
    assert (np.diff(m.thresholds) >= 0).all()
    up = toxicity._sigmoid(np.array([m.weights[i].sum() for i in index])[:, None] - m.thresholds)
    mean = [up.sum(1)[grade == g].mean() for g in range(4)]
    assert mean == sorted(mean) and mean[0] < 0.3 and mean[3] > 2


def test_cells_reach_every_link():
    r = np.random.default_rng(1)
    x = r.normal(size=(1500, 32))
    x = np.concatenate([x, x[:300] + 0.2 * r.normal(size=(300, 32)) * np.linalg.norm(x[:300], axis=1)[:, None] / 32**0.5])
    x /= np.linalg.norm(x, axis=1)[:, None]
    c = spherical_kmeans(x, 40)
    near = {(a, b) for a, b in np.argwhere(x @ x.T >= 0.95).tolist() if a != b}
    assert len(near) > 300
    s = x @ c.T
    home = s.argmax(axis=1)
    away = np.arccos(np.clip(s.max(axis=1), -1, 1))
    radius = np.array([away[home == k].max(initial=-1) for k in range(len(c))])
    for margin, least in ((1.0, 1.0), (4 / 32**0.5, 0.999)):
        meets = visited(x, home, c, radius, 0.95, margin)
        assert sum(meets[a, home[b]] for a, b in near) >= least * len(near)
