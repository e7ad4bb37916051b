"""Operators against brute force, exact round trips and held-out accuracy."""

import hashlib
import random
import re

import numpy as np
import pytest

from conftest import SF_SMALL
from riskframe.llm import bpe, langid, license_scan, quality, simhash, substring_dedup


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()}


def test_bpe_equals_tiktoken(texts):
    import public_tokenizers
    import tiktoken

    ranks = bpe.read_ranks(public_tokenizers.path(bpe.VOCABULARY))
    codec = bpe.BytePairCodec(ranks, public_tokenizers.PATTERN)
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng, tokens = random.Random(3), list(ranks)
    odd = ["".join(rng.choice("abcdehinorst ÄößéЖ中😀\n\t\x1c\x85　 0129'²") for _ in range(rng.randint(0, 120))) for _ in range(800)]
    odd += [b"".join(rng.choices(tokens, k=8)).decode("utf-8", "ignore") for _ in range(1500)] + ["a" * 20000, "ab" * 9000, " " * 500, "\n" * 99]
    for t in [*texts.values(), *odd]:
        ids = codec.encode(t)
        assert memoryview(ids).cast("I").tolist() == encoding.encode_ordinary(t), t[:80]
        assert codec.decode(ids) == t.encode("utf-8")


def _components(fps, bits):
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= bits
    least = np.arange(len(fps))
    while True:
        new = np.array([least[near[i]].min() for i in range(len(fps))])
        if (new == least).all():
            return least
        least = new


@pytest.mark.parametrize("seed", range(20))
def test_gray_index_equals_all_pairs(seed):
    rng = np.random.default_rng(seed)
    fps = rng.integers(0, 2 ** 63, 300, dtype=np.uint64)[rng.integers(0, 300 if seed % 2 else 9, 300)]
    for _ in range(seed % 5):
        fps = fps ^ (np.uint64(1) << rng.integers(0, 64 if seed % 3 else 10, 300).astype(np.uint64))
    fps = np.unique(fps)
    a, b = simhash.GrayIndex(fps).forest(3)
    assert (np.bitwise_count(fps) >= 0).all()
    place = {int(x): i for i, x in enumerate(fps)}
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, y in zip(a.tolist(), b.tolist()):
        i, j = sorted((find(place[x]), find(place[y])))
        root[j] = i
    assert [find(i) for i in range(len(fps))] == _components(fps, 3).tolist()


@pytest.mark.parametrize("hot", [2, simhash.HOT])
def test_simhash_query_equals_brute_force(spark, texts, hot):
    import xxhash

    def fp(text):
        words = re.findall(rb"[^\x20\x09-\x0D]+", text.encode().lower())
        if not words:
            return 0
        k = min(3, len(words))
        hs = [xxhash.xxh64_intdigest(b" ".join(words[i:i + k]), 42) for i in range(len(words) - k + 1)]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))

    ids = sorted(texts)
    fps = np.array([fp(texts[i]) for i in ids], np.uint64)
    least = _components(fps, 3)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"])
           for r in simhash.simhash_components(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), 3, 3, hot=hot).collect()}
    assert got == {i: (f"{int(f):016x}", ids[r]) for i, f, r in zip(ids, fps, least)}


def test_licenses_equal_brute_force(spark, texts):
    k = license_scan.SHINGLE

    def words(t):
        return re.findall(r"[^\W_]+", t.lower())

    def shingles(w):
        return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}

    rng = random.Random(5)
    docs = dict(texts)
    for n, (name, t) in enumerate(license_scan.TEMPLATES.items()):  # whole, edited and cut templates inside texts
        w = t.split()
        for j, part in enumerate((w, w[:len(w) // 2], [x for i, x in enumerate(w) if i % 30 != 17], rng.sample(w, len(w)))):
            docs[10_000 + 10 * n + j] = "before it " + " ".join(part) + " after"
    want = set()
    for i, t in docs.items():
        w = words(t)
        for name, template in license_scan.TEMPLATES.items():
            tw = words(template)
            more, ts = len(tw) // 5 + 1, shingles(tw)
            if ts & shingles(w) and any(len(ts & shingles(w[max(a - more, 0):a + len(tw) + more])) >= 0.8 * len(ts) for a in range(len(w))):
                want.add((i, name))
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    assert {(r["doc_id"], r["license"]) for r in license_scan.scan(frame).collect()} == want and len(want) > 20


def test_viterbi_is_optimal():
    rng = np.random.default_rng(1)
    for _ in range(30):
        n, k = rng.integers(0, 30, 4), int(rng.integers(1, 5))
        scores = (rng.normal(size=(n.sum(), k)) * 3).astype(np.float32)
        text_of = np.repeat(np.arange(4), n)
        path = langid.viterbi(scores, text_of, 4, 2.0, 8)
        for t in range(4):
            s, p = scores[text_of == t], path[text_of == t]
            if not len(s):
                continue
            v = s[0].astype(float)
            for x in s[1:]:
                v = np.maximum(v, v.max() - 2.0) + x
            assert abs(s[np.arange(len(s)), p].sum() - 2.0 * (p[1:] != p[:-1]).sum() - v.max()) < 1e-3


SF = "/root/testdata/sf0.01"


def test_language_held_out_accuracy(spark):
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    held = [r for r in langid.query(spark, SF).collect() if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) / len(held) > 0.98


def test_quality_held_out_accuracy(spark):
    truth = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held = [r for r in quality.query(spark, SF).collect() if r["held_out"] and r["doc_id"] in truth]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) / len(held) > 0.95


def test_isotonic_pool_rises():
    at, value = quality.pool(np.arange(6.0), np.array([0, 2, 1, 1, 3, 2.0]), np.array([3, 3, 3, 3, 3, 2.0]))
    assert (np.diff(value) > 0).all() and (np.diff(at) > 0).all()


@pytest.mark.parametrize("frequent", [0, substring_dedup.FREQUENT, 1 << 40])
def test_substring_dedup_equals_brute_force(spark, texts, frequent, monkeypatch):
    """A common phrase in different surroundings, dealt by anchor, by window or mixed."""
    rng = random.Random(11)
    vocabulary = [f"v{i}" for i in range(30)]
    docs = dict(texts)
    for n in range(150):
        body = [" ".join(rng.choices(vocabulary, k=rng.randint(5, 25))) for _ in range(3)]
        docs[20_000 + n] = " a common phrase of just six ".join(body) + (" " + docs[20_000 + n // 2] if n % 3 == 1 else "")
    length, first, want = substring_dedup.LENGTH, {}, {}
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", t) for i, t in sorted(docs.items())}
    for i, w in words.items():
        gone = set()
        for at in range(len(w) - length + 1):
            if first.setdefault(tuple(w[at:at + length]), i) < i:
                gone.update(range(at, at + length))
        want[i] = (len(w), len(gone), hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest())
    monkeypatch.setattr(substring_dedup, "FREQUENT", frequent)
    monkeypatch.setattr(substring_dedup, "ONE_IN", 1)
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(7)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substring_dedup.remove_repeats(frame).collect()}
    assert got == want and sum(x[1] for x in want.values()) > 1000
    keyed = substring_dedup._keyed(frame, "doc_id", "text")
    assert (len(substring_dedup.frequent_anchors(keyed)) > 0) == (frequent < 1 << 40)
