"""Nulls, empty and long texts, ties, repeated rows, empty tables and extra columns."""

import hashlib

import pytest
from pyspark.sql import functions as F

from riskframe.llm import bpe, chat_format, decontaminate, exact_dedup, langid, license_scan, quality, simhash, substring_dedup, warc
from riskframe.llm.components import connected_components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h long, norm string, _path string, words string, fp long, key string"
WORDS = [f"word{i}" for i in range(40)]
LONG = " ".join(f"w{i % 977}" for i in range(60_000))
ROWS = [(1, " ".join(WORDS)), (2, " ".join(WORDS)), (2, " ".join(WORDS)), (3, None), (4, ""), (5, LONG), (None, "One two  three"),
        (6, "one\ttwo three"), (7, "O n e two three"), (8, "Licensed under the Apache License, Version 2.0.")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, None, None, None, 1, "x", "y", "z", 0, "k") for i, t in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.limit(0)


def ids():
    import public_tokenizers

    return bpe.read_ranks(public_tokenizers.path(bpe.VOCABULARY)), public_tokenizers.PATTERN


def test_bpe(spark, docs, nothing):
    got = bpe.encode_documents(docs, *ids()).collect()
    assert len(got) == len(ROWS) and bpe.encode_documents(nothing, *ids()).count() == 0
    want = {hashlib.sha256((t or "").encode()).hexdigest() for _, t in ROWS}
    assert {r["decoded_sha256"] for r in got} == want
    assert all(r["n_tokens"] == 0 for r in got if r["doc_id"] in (3, 4))


def test_exact_dedup(docs, nothing):
    got = exact_dedup.exact_groups(docs).collect()
    assert exact_dedup.exact_groups(nothing).count() == 0
    by = {}
    for r in got:
        by.setdefault(r["keep_id"], []).append(r)
    assert sorted((k, len(v), sum(x["kept"] for x in v)) for k, v in by.items() if k is not None) == [(1, 3, 1), (3, 2, 1), (5, 1, 1), (6, 1, 1), (7, 2, 1), (8, 1, 1)]
    assert exact_dedup.drop_copies(docs).count() == 6 and exact_dedup.drop_copies(docs).columns == docs.columns


def test_exact_dedup_survives_digest_clashes(docs):
    def columns(df):
        return sorted(map(tuple, df.select("doc_id", "keep_id", "group_size", "kept").collect()), key=str)

    weak = exact_dedup.exact_groups(docs, digest=lambda norm: F.substring(exact_dedup.sha256_digest(norm), 1, 0))
    assert columns(weak) == columns(exact_dedup.exact_groups(docs))


def test_simhash(docs, nothing):
    got = simhash.simhash_components(docs, 3, 3).collect()
    assert len(got) == len(ROWS) and simhash.simhash_components(nothing, 3, 3).count() == 0
    zero = [r for r in got if r["doc_id"] in (3, 4)]
    assert {(r["fingerprint"], r["component_id"]) for r in zero} == {("0" * 16, 3)}
    kept = simhash.drop_near_copies(docs, 3, 3)
    assert kept.columns == docs.columns and kept.count() == len({r["component_id"] for r in got})


def test_components(spark):
    edges = spark.createDataFrame([(5, 4), (4, 3), (9, 8), (8, 9), (7, 7), (None, 1), (3, 20), (20, 21)], "a long, b long")
    assert {r["vertex"]: r["root"] for r in connected_components(edges).collect()} == {3: 3, 4: 3, 5: 3, 20: 3, 21: 3, 8: 8, 9: 8}
    assert connected_components(edges.limit(0)).count() == 0


def test_substring_dedup(docs, nothing):
    got = {(r["doc_id"], r["n_words"]): r["n_removed"] for r in substring_dedup.remove_repeats(docs).collect()}
    assert got == {(1, 40): 0, (2, 40): 40, (3, 0): 0, (4, 0): 0, (5, 60_000): 0, (None, 3): 0, (6, 3): 0, (7, 5): 0, (8, 7): 0}
    assert substring_dedup.remove_repeats(docs).count() == len(ROWS) and substring_dedup.remove_repeats(nothing).count() == 0


def test_quality(spark, docs, nothing):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, None, 0), (None, 1, 0), (5, 1, 0), (5, 1, 1)], "doc_id long, quality int, toxic int")
    got = quality.score_documents(docs, labels).collect()
    assert len(got) == len(ROWS) and all(0 <= r["score"] <= 1 for r in got)
    assert quality.score_documents(nothing, labels).count() == 0
    assert {r["score"] for r in quality.score_documents(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.keep_good(docs, labels).columns == docs.columns


def test_language(docs, nothing):
    assert {r["lang_pred"] for r in langid.label_spans(docs, langid.train(docs)).collect()} == {"und"}  # nothing to learn from
    model = langid.train(docs.withColumn("lang", F.when(F.col("doc_id") < 3, "a").when(F.col("doc_id") > 4, "b")))
    got = langid.label_spans(docs, model).collect()
    assert {r["lang_pred"] for r in got if r["doc_id"] in (3, 4)} == {"und"} and len(got) == len(ROWS)
    assert langid.label_spans(nothing, model).count() == 0


def test_licenses(docs, nothing):
    assert [(r["doc_id"], r["license"], r["containment"]) for r in license_scan.scan(docs).collect()] == [(8, "apache-2.0-line", 1.0)]
    assert license_scan.scan(nothing).count() == 0
    with pytest.raises(ValueError):
        license_scan.scan(docs, {"short": "too short"})


def test_decontamination(spark, docs, nothing):
    bench = spark.createDataFrame([(1, " ".join(WORDS)), (1, None), (2, ""), (None, "a b c d e f"), (3, "3 4 5 6 7 8 9 10")], "item_id long, text string")
    assert sorted(map(tuple, decontaminate.leaks(docs, bench).select("doc_id", "item_id", "share").collect())) == [(1, 1, 1.0), (2, 1, 1.0)]
    assert decontaminate.leaks(nothing, bench).count() == 0 and decontaminate.leaks(docs, bench.limit(0)).count() == 0
    kept = decontaminate.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and kept.count() == len(ROWS) - 3


def test_chat(spark):
    schema = "conv_id long, turn long, role string, text string, segment string, first long"
    rows = [(1, 0, "user", None), (1, 1, "assistant", r"a\<[</s>[INST]"), (1, 1, "assistant", "b"), (None, 0, None, "x"), (2, None, "assistant", LONG), (2, 0, "user", "")]
    chats = spark.createDataFrame([(*r, "s", 1) for r in rows], schema)
    got = {r["conv_id"]: r for r in chat_format.read_back(chat_format.format_turns(chats)).collect()}
    text = "user\n\nassistant\na\\<[</s>[INST]\nassistant\nb\n"
    assert got[1]["turns_sha256"] == hashlib.sha256(text.encode()).hexdigest() and got[1]["n_examples"] == 2
    assert got[1]["loss_sha256"] == hashlib.sha256(r"a\<[</s>[INST]b".encode()).hexdigest()
    assert got[2]["loss_chars"] == len(LONG) and got[None]["loss_chars"] == 0
    assert chat_format.read_back(chat_format.format_turns(chats.limit(0))).count() == 0


def test_chat_contexts_hold_all_preceding_turns(spark):
    chats = spark.createDataFrame([(7, i, "assistant" if i % 2 else "user", f"t{i}[{i}]") for i in range(6)], "conv_id long, turn long, role string, text string")
    turns = chat_format.format_turns(chats)
    got = sorted(map(tuple, chat_format.render(turns, chat_format.examples(turns)).collect()))
    segment = [chat_format.TURN + ("assistant" if i % 2 else "user") + chat_format.SAYS + chat_format.escape(f"t{i}[{i}]") + chat_format.END for i in range(6)]
    head = chat_format.TURN + "assistant" + chat_format.SAYS
    assert got == [(7, i, "".join(segment[:i]) + head, chat_format.escape(f"t{i}[{i}]")) for i in (1, 3, 5)]


def test_chat_expands_every_reply_with_its_whole_context(spark):
    rows = [(c, i, "assistant" if i % 2 == c % 2 else "user", f"<{c}>t{i}[\\é" * (i + 1)) for c, n in ((1, 5), (2, 6), (3, 120)) for i in range(n)]
    rows += [(4, 0, "user", "no reply"), (4, 1, "user", "at all"), (5, 0, "assistant", None), (None, 0, "assistant", "a"), (None, 1, "user", "b")]
    turns = chat_format.format_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    want, texts = [], {}
    for c in dict.fromkeys(r[0] for r in rows):
        whole = ""
        own = [r for r in rows if r[0] == c]
        for seq, (_, _, role, text) in enumerate(own):
            head, body = chat_format.TURN + role + chat_format.SAYS, chat_format.escape(text or "")
            if role == "assistant":
                want.append((c, seq, whole + head, body))
            whole += head + body + chat_format.END
        if own[-1][2] != "assistant":
            want.append((c, len(own) - 1, whole, None))
        texts[c] = "".join(f"{role}\n{text or ''}\n" for _, _, role, text in own), "".join(text or "" for _, _, role, text in own if role == "assistant")
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    expanded = chat_format.expand(turns)
    assert sorted(map(tuple, expanded.collect()), key=key) == sorted(want, key=key)
    got = {r["conv_id"]: r for r in chat_format.read_examples(expanded).collect()}
    assert {c: (r["turns_sha256"], r["loss_sha256"]) for c, r in got.items()} == {
        c: tuple(hashlib.sha256(x.encode()).hexdigest() for x in pair) for c, pair in texts.items()}
    unmasked = chat_format.read_examples(spark.createDataFrame([(1, 0, "<|turn|>user<|says|>x<|end|>", None)], expanded.schema)).first()
    assert (unmasked["n_turns"], unmasked["loss_chars"], unmasked["n_examples"]) == (1, 0, 0)
    broken = spark.createDataFrame([(1, 0, "<|turn|>assistant<|says|>", "x"), (1, 1, "<|turn|>assistant<|says|>", "y")], expanded.schema).coalesce(1)
    with pytest.raises(Exception, match="does not go on"):
        chat_format.read_examples(broken).collect()


def test_warc(spark, tmp_path):
    html = ('<html lang="en"><head><title>T &amp; U</title><script>var t="</p>";</script></head><body><!-- x --><p>One<br>two &lt;b&gt;</p>'
            '<a href="/a?b=1">l</a><p title="a>b">three</p><!-- open')
    pages = spark.createDataFrame([(1, "http://h.example/x/", html, 5), (1, "http://h.example/x/", html, 5), (2, None, None, 5), (None, "::", "<p", 5)],
                                  "page_id long, url string, html string, block int")
    records = warc.derive(warc.pages_to_responses(pages))
    got = {(r["page_id"], r["warc_type"]): r for r in records.collect()}
    assert records.count() == 8 and got[1, "conversion"]["block"] == "One\ntwo <b>\nl\nthree"
    assert "title: T & U\r\n" in got[1, "metadata"]["block"] and "outlink: http://h.example/a?b=1 a/@href\r\n" in got[1, "metadata"]["block"]
    assert got[1, "metadata"]["refers_to"] == got[1, "conversion"]["refers_to"] and got[2, "conversion"]["block"] == ""
    warc.write(records.coalesce(1), str(tmp_path / "w"))
    data = next((tmp_path / "w").glob("part-*")).read_bytes()
    n = 0
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        size = int(head.rsplit(b"Content-Length: ", 1)[1])
        assert warc.sha1_digest(rest[:size]).encode() in head and rest[size:size + 4] == b"\r\n\r\n"
        data, n = rest[size + 4:], n + 1
    assert n == 8 and warc.derive(warc.pages_to_responses(pages.limit(0))).count() == 0


def test_decontamination_meets_reparameterised_questions(spark):
    item = "At the shop old Maria Lopez bought 12 kg of flour and 7 boxes of tea, then Maria Lopez paid $30 for 12 kg of rice in cash."
    same = item.replace("Maria Lopez", "Jonas Berg").replace("12", "45").replace("7", "9").replace("30", "88")
    mixed = item.replace("Maria Lopez bought 12", "Jonas Berg bought 45").replace("paid $30 for 12", "paid $88 for 99").replace("then Maria Lopez", "then Eva Stone")
    docs = spark.createDataFrame([(1, "we say first. " + same + " and more"), (2, mixed), (3, "nothing of the kind is written here at all today")], "doc_id long, text string")
    got = {r["doc_id"]: r["share"] for r in decontaminate.leaks(docs, spark.createDataFrame([(1, item)], "item_id long, text string"), coverage=0.0).collect()}
    assert got[1] > 0.9 and got[2] < got[1] and 3 not in got
