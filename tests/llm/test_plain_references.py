"""Queries and pipeline stages against plain re-computations of their rules."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from conftest import SF_SMALL
from riskframe.llm import decontaminate as D
from riskframe.llm import langid, quality


def read(spark, name, sf=SF_SMALL):
    return spark.read.parquet(f"{sf}/{name}.parquet")


# ------------------------------------------------------------------ decontamination
PLAIN_NAMES = D.NAMES.replace("++", "+").replace("*+", "*")
PLAIN_NUMBERS = D.NUMBERS.replace("++", "+").replace("*+", "*")


def tokens(text, names):
    t = regex.sub(D.RESERVED, " ", text or "")
    t = regex.sub(PLAIN_NAMES, lambda m: m[1] + D.NAME + m[2] + D.END, t) if names else t
    t = regex.sub(PLAIN_NUMBERS, lambda m: D.NUM + m[0] + D.END, t)
    t = regex.sub(D.UNIT_WORDS, lambda m: m[1] + D.UNIT + m[2] + D.END, t)
    t = regex.sub(D.SIGNS, lambda m: D.UNIT + m[0] + D.END, t)
    return regex.findall(D.TOKENS, t.lower())


def is_slot(t):
    return D.NUM <= t < D.END


def windows(toks, n):
    """(canonical tokens, slot values) of each window."""
    out = []
    for i in range(len(toks) - n + 1):
        w = toks[i:i + n]
        out.append((tuple(t[0] if is_slot(t) else t for t in w), tuple(t for t in w if is_slot(t))))
    return out


def letters(t):
    return len(regex.sub(r"[^\p{L}\p{Nd}]", "", t))


def plain_leaks(docs, bench, window=D.WINDOW, literal=D.LITERAL, coverage=D.COVERAGE):
    """{(doc_id, item_id): share} of texts given as (doc_id, text) with distinct ids."""
    items = sorted({(i, t) for i, t in bench if i is not None}, key=str)
    best = {}
    evidence, index = {}, ({}, {})
    for item in items:
        typed_at, own = {}, ([], [])
        for form in (0, 1):
            toks, before = tokens(item[1], form == 0), 0
            for pos, (canon, slots) in enumerate(windows(toks, window)):
                place = 2 * before + (letters(toks[pos]) > 0)
                before += letters(toks[pos])
                if len(slots) <= window - literal:
                    own[form].append((pos, place, canon, slots))
                    if form == 0:
                        typed_at[place] = min(pos, typed_at.get(place, pos))
        evidence[item] = (len(own[0]), len(own[1]))
        for form in (0, 1):
            for pos, place, canon, slots in own[form]:
                index[form].setdefault(canon, []).append((item, pos, None if form == 0 else typed_at.get(place), slots))
    for doc_id, text in docs:
        found = Counter()
        forms = (tokens(text, True), tokens(text, False))
        for form in (0, 1):
            for pos, (canon, slots) in enumerate(windows(forms[form], window)):
                for item, item_pos, typed_pos, item_slots in index[form].get(canon, ()):
                    found[item, form, item_pos, typed_pos, pos - item_pos, item_slots, slots] += 1
        along = defaultdict(set)
        for item, form, item_pos, _, shift, _, _ in found:
            along[item, form, shift].add(item_pos)
        pairs = {}
        for (item, form, _, _, shift, a, b), times in found.items():
            for x, y in zip(a, b):
                most, n = pairs.get((item, form, x, y), (0, 0))
                pairs[item, form, x, y] = (max(most, len(along[item, form, shift])), n + times)
        chosen = {}
        for (item, form, x, y), rank in pairs.items():
            chosen[item, form, x] = max(chosen.get((item, form, x), ((0, 0), "")), (rank, y))
        counted = defaultdict(set)
        for item, form, item_pos, typed_pos, _, a, b in found:
            if all(chosen[item, form, x][1] == y for x, y in zip(a, b)):
                for by, at in ((0, item_pos), (1, item_pos)) if form == 0 else ((1, typed_pos), (2, item_pos)):
                    if at is not None:
                        counted[item, by].add(at)
        for (item, by), at in counted.items():
            share = len(at) / evidence[item][0 if by < 2 else 1]
            if share >= coverage:
                best.setdefault((doc_id, item), {})[by] = share
    out = {}
    for (doc_id, item), shares in best.items():
        out[doc_id, item[0]] = max(out.get((doc_id, item[0]), 0), shares[min(shares)])
    for item in items:  # items without an evidence window: word for word
        own = tokens(item[1], False)
        if sum(evidence[item]) or not own:
            continue
        n = min(len(own), window)
        wanted = [tuple(own[i:i + n]) for i in range(len(own) - n + 1)]
        for doc_id, text in docs:
            toks = tokens(text, False)
            have = {tuple(toks[i:i + n]) for i in range(len(toks) - n + 1)}
            share = sum(w in have for w in wanted) / len(wanted)
            if share >= coverage:
                out[doc_id, item[0]] = max(out.get((doc_id, item[0]), 0), share)
    return out


def test_decontamination_equals_plain_rules(spark):
    docs = [(r["doc_id"], r["text"]) for r in read(spark, "documents").collect()]
    bench = [(r["item_id"], r["text"]) for r in read(spark, "benchmark").collect()]
    docs += [(10_000 + 4 * i + k, "note: " + change(t) + " so it ends") for i, t in bench[:25]
             for k, change in enumerate((str.upper, str.title, lambda t: t[:len(t) * 2 // 3], lambda t: re.sub(r"\d+", lambda m: str(int(m[0]) * 3 + 1), t)))]
    bench += [(900, "Who wrote Pride?"), (900, "3 4 5 6 7 8 9 10"), (901, "x"), (902, "?"), (903, None), (None, "a b c d e f"), bench[0], (bench[1][0], bench[2][1])]
    docs += [(20_000, "who WROTE pride"), (20_001, "of 3 4 5 6 7 8 9 10"), (20_002, None), (20_003, ""), (20_004, "an x b")]
    got = {(r["doc_id"], r["item_id"]): r["share"] for r in D.leaks(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")).collect()}
    want = plain_leaks(docs, bench)
    assert {k: (got.get(k), want.get(k)) for k in got.keys() | want.keys() if got.get(k) != want.get(k)} == {} and len(got) > 90


# ------------------------------------------------------------------ languages
def bucket(a, b, c):
    x = (a * 0x9E3779B1 ^ (b * 0x85EBCA77 + 1) ^ c * 0xC2B2AE3D) & 0xFFFFFFFF
    return ((x ^ x >> 15) * 0x2C1B3C6D & 0xFFFFFFFF) >> 16


def letter_words(text):
    low = [(c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else None for c in text]
    at, out = 0, []
    while at < len(low):
        end = at
        while end < len(low) and low[end] is not None:
            end += 1
        if end > at:
            out.append((text[at], [ord(c) for c in low[at:end]]))
        at = end + 1
    return out


def script(c):
    k = sum(ord(c) >= s for s in langid.SCRIPTS)
    return 1 if k in (1, 14) else k


def word_buckets(w):
    return [bucket(w[i - 1] if i else 0, w[i], w[i + 1] if i + 1 < len(w) else 0) for i in range(len(w))]


def test_language_query_equals_plain_viterbi(spark):
    rows = read(spark, "documents").select("doc_id", "text", "lang", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h")).collect()
    languages = sorted({r["lang"] for r in rows if r["h"] % 4 != 2 and r["lang"]})
    counts, scripts = {g: Counter() for g in languages}, {g: Counter() for g in languages}
    for r in rows:
        if r["h"] % 4 != 2 and r["lang"] and r["text"]:  # fewer texts than the sample takes: all are learned from
            for first, w in letter_words(r["text"]):
                counts[r["lang"]].update(word_buckets(w))
            scripts[r["lang"]].update(script(c) for c in r["text"] if c.isalpha())
    total = {g: sum(counts[g].values()) + langid.SMOOTH * langid.BUCKETS for g in languages}
    known = {g: {s for s, n in scripts[g].items() if n / sum(scripts[g].values()) > 1e-4} for g in languages}
    got = {r["doc_id"]: r for r in langid.query(spark, SF_SMALL).collect()}
    for r in rows:
        words = letter_words(r["text"] or "")
        if not words:
            assert (got[r["doc_id"]]["lang_pred"], got[r["doc_id"]]["score"]) == ("und", 0.0)
            continue
        value, back = [0.0] * len(languages), []
        for first, w in words:
            allowed = [script(first) in known[g] for g in languages]
            own = [sum(np.log((counts[g][b] + langid.SMOOTH) / total[g]) for b in word_buckets(w)) + (langid.FLOOR if any(allowed) and not ok else 0)
                   for g, ok in zip(languages, allowed)]
            top = max(range(len(languages)), key=lambda k: (value[k], -k))
            came = [k if value[k] >= value[top] - langid.SWITCH else top for k in range(len(languages))]
            back.append(came)
            value = [max(value[k], value[top] - langid.SWITCH) + own[k] for k in range(len(languages))]
        state, letters_of = max(range(len(languages)), key=lambda k: (value[k], -k)), Counter()
        for (_, w), came in zip(reversed(words), reversed(back)):
            letters_of[state] += len(w)
            state = came[state]
        best = max(range(len(languages)), key=lambda k: (letters_of[k], -k))
        assert got[r["doc_id"]]["lang_pred"] == languages[best] and got[r["doc_id"]]["held_out"] == (r["h"] % 4 == 2)
        assert abs(got[r["doc_id"]]["score"] - letters_of[best] / sum(letters_of.values())) < 1e-9


# ------------------------------------------------------------------ quality
def plain_isotonic(y, w):
    """max over starts of min over ends of the mean, at each place."""
    n = len(y)
    mean = lambda a, b: sum(y[a:b + 1]) / sum(w[a:b + 1])
    return [max(min(mean(a, b) for b in range(i, n)) for a in range(i + 1)) for i in range(n)]


def test_quality_query_equals_least_squares_and_isotonic_regression(spark):
    rows = read(spark, "documents").select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"),
                                          F.pmod(F.xxhash64("doc_id"), F.lit(quality.CALIBRATION_FOLDS)).alias("fold")).collect()
    label = {r["doc_id"]: r["quality"] for r in read(spark, "labels").collect()}
    x = np.array([quality.statistics(r["text"] or "") for r in rows])
    mine = [i for i, r in enumerate(rows) if r["h"] % 3 != 1 and label.get(r["doc_id"]) is not None]
    y = np.array([label[rows[i]["doc_id"]] for i in mine], float)
    scale = x[mine].std(axis=0)
    z = np.clip((x - x[mine].mean(axis=0)) / np.where(scale > 1e-9, scale, 1), -8, 8)
    rng = np.random.default_rng(quality.SEED)
    w = rng.normal(size=(x.shape[1], quality.FEATURES)) / quality.BANDWIDTH
    phi = np.hstack([np.sqrt(2 / quality.FEATURES) * np.cos(z @ w + rng.uniform(0, 2 * np.pi, quality.FEATURES)), np.ones((len(x), 1))])
    fold = np.array([rows[i]["fold"] for i in mine])
    learn, n = phi[mine][fold != 0], (fold != 0).sum()
    penalty = np.sqrt(np.append(np.full(quality.FEATURES, quality.RIDGE * n), 1e-9 * n))
    beta = np.linalg.lstsq(np.vstack([learn, np.diag(penalty)]), np.append(y[fold != 0], np.zeros(len(penalty))), rcond=None)[0]
    raw = phi @ beta
    bins = np.rint((np.clip(raw[mine][fold == 0], -0.5, 1.5) + 0.5) / 2 * quality.BINS)
    places = np.unique(bins)
    base = y[fold == 0].mean()
    weight = np.array([(bins == b).sum() + 0.1 for b in places])
    level = np.array(plain_isotonic([y[fold == 0][bins == b].sum() + 0.1 * base for b in places], weight.tolist()))
    centre, value = [], []
    for v in np.unique(np.round(level, 12)):
        same = np.abs(level - v) < 1e-9
        centre.append(((places[same] / quality.BINS * 2 - 0.5) * weight[same]).sum() / weight[same].sum())
        value.append(level[same][0])
    want = np.clip(np.interp(raw, centre, value), 0, 1)
    got = {r["doc_id"]: r for r in quality.query(spark, SF_SMALL).collect()}
    # sums cross the shuffle as integers of 2^-20, and a bin's edge may lie between: nearly all agree closely
    apart = np.array([abs(got[r["doc_id"]]["score"] - s) for r, s in zip(rows, want)])
    assert np.quantile(apart, 0.97) < 1e-3 and apart.max() < 0.1
    assert all(got[r["doc_id"]]["held_out"] == (r["h"] % 3 == 1) and got[r["doc_id"]]["predicted"] == int(got[r["doc_id"]]["score"] >= 0.5) for r in rows)


# ------------------------------------------------------------------ pipeline
def plain_fingerprint(text):
    import xxhash

    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return 0
    k = min(3, len(words))
    hs = [xxhash.xxh64_intdigest(b" ".join(words[i:i + k]), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_exact(rows):
    best = {}
    for i, t in rows:
        key = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        best[key] = min(best.get(key, (1, 0, None)), (-len(t or ""), i is None, i or 0, t), key=lambda r: r[:3]) if key in best else (-len(t or ""), i is None, i or 0, t)
    return sorted((None if none else i, t) for _, none, i, t in best.values())


def plain_near(rows):
    fps = np.array([plain_fingerprint(t) for _, t in rows], np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3
    least = np.arange(len(rows))
    while True:
        new = np.array([least[near[i]].min() for i in range(len(rows))])
        if (new == least).all():
            return [r for i, r in enumerate(rows) if least[i] == i]
        least = new


@pytest.fixture(scope="module")
def corpus(spark):
    """The small table, copies and near copies of some texts, leaks, and texts of runs that once broke patterns."""
    docs = read(spark, "documents")
    some = [r for r in docs.orderBy("doc_id").limit(12).collect() if r["text"]]
    item = read(spark, "benchmark").first()["text"]
    extra = [(50_000 + k, r["text"] + "\n", r["lang"], r["source"], r["n_chars"]) for k, r in enumerate(some)]
    extra += [(60_000 + k, r["text"] + " too", r["lang"], r["source"], r["n_chars"]) for k, r in enumerate(some)]
    extra += [(70_000, (some[0]["text"] + " ") * 2 + item.upper(), "en", "s", 1), (70_001, None, None, None, None), (70_002, "", "en", "s", 0),
              (70_003, some[1]["text"] + " " + "North Sea " * 3_000, "en", "s", 1), (70_004, some[2]["text"] + " " + "x y z " * 100_000, "en", "s", 1)]
    return docs.select("doc_id", "text", "lang", "source", "n_chars").unionByName(spark.createDataFrame(extra, docs.select("doc_id", "text", "lang", "source", "n_chars").schema))


def test_pipeline_stages_equal_plain_recomputation(spark, corpus, tmp_path):
    import public_tokenizers
    import tiktoken

    import corpus_pipeline as p
    from riskframe.llm import bpe

    path = str(tmp_path / "in")
    corpus.write.parquet(path)
    docs, kept = spark.read.parquet(path), None
    bench = [(r["item_id"], r["text"]) for r in read(spark, "benchmark").collect()]
    score = {r["doc_id"]: r["score"] for r in quality.score_documents(docs, read(spark, "labels")).collect()}
    want = sorted((r["doc_id"], r["text"]) for r in docs.collect() if score[r["doc_id"]] >= 0.5)
    steps = {"quality": lambda rows: want, "exact_dedup": plain_exact, "near_dedup": plain_near,
             "decontamination": lambda rows: [r for r in rows if r[0] not in {d for d, _ in plain_leaks(rows, bench)}]}
    for name, stage in p.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        before, docs = kept, spark.read.parquet(str(tmp_path / name))
        kept = steps[name](before)
        assert sorted((r["doc_id"], r["text"]) for r in docs.collect()) == kept, name
        assert before is None or len(kept) < len(before)
    ranks = bpe.read_ranks(public_tokenizers.path(bpe.VOCABULARY))
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    final = {r["doc_id"]: r for r in p.STAGES[-1][1](spark, docs, SF_SMALL).collect()}
    assert set(final) == {i for i, _ in kept}
    for i, t in kept:
        ids = np.array(encoding.encode_ordinary(t or ""), "<u4").tobytes()
        assert final[i]["ids_sha256"] == hashlib.sha256(ids).hexdigest()


def test_pipeline_stages_on_odd_rows(spark):
    """Nulls, empty and repeated rows, clashing names; and empty tables."""
    import corpus_pipeline as p

    rows = [(None, None, "a"), (None, "", "b"), (1, "same words here and there in a text", "c"), (1, "same words here and there in a text", "d"), (2, " same words here\nand there in a text", "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _path string").withColumns({"h": F.lit(1), "words": F.lit("w"), "lang": F.lit(None).cast("string")})
    for frame in (docs, docs.limit(0)):
        for name, stage in p.STAGES[:-1]:
            out = stage(spark, frame, SF_SMALL)
            assert out.columns == frame.columns, name
            assert out.count() <= frame.count(), name
        assert p.STAGES[-1][1](spark, frame, SF_SMALL).count() == frame.count()
    assert sorted(r["_path"] for r in p.drop_copies(spark, docs, SF_SMALL).collect()) == ["a", "e"] or p.drop_copies(spark, docs, SF_SMALL).count() == 2
