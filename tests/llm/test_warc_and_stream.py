"""Derivatives against the tag pattern they replace, in time that grows with the page; deduplication in several batches."""

import random
import re
import time

from conftest import SF_SMALL
from riskframe.llm import exact_dedup, warc

PATTERN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|title|textarea)\b((?:[^'\">]+|\"[^\"]*\"|'[^']*')*)>(.*?)(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)(?=[\s/>])((?:[^'\">]+|\"[^\"]*\"|'[^']*')*)>|</?[a-zA-Z][^>]*>", re.S | re.I)
PIECES = ["<a href='x'>", "<a href=\"y z\">", "<p", ">", "'", '"', "</p>", "<!--", "-->", "<!x>", "<?php ", "<script>", "</script>", "<SCRIPT src=q.js>", "</Script >", "<title>", "</title>",
          "text", " ", "/", "<br/>", "<td>", "</td>", "<textarea>", "<", "< b", "a<b", "=", "<a'b>", "<script'>'>", "\n"]


def by_pattern(html):
    out = []
    for m in PATTERN.finditer(html):
        if m[1] is not None:
            out.append((*m.span(), m[1].lower(), False, m[2], m[3]))
        elif m[5] is not None:
            out.append((*m.span(), m[5].lower(), bool(m[4]), m[6], None))
        else:
            out.append((*m.span(), "", False, "", None))
    return out


def test_scanner_equals_the_pattern():
    rng = random.Random(1)
    for _ in range(6000):
        html = "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 14)))
        got = [(p.start, p.end, p.name, p.closes, p.attributes, p.raw) for p in warc._Scanner(html)]
        assert got == by_pattern(html), html


def test_scanner_equals_the_pattern_on_pages(spark):
    for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").limit(300).collect():
        html = r["html"] or ""
        assert [(p.start, p.end, p.name, p.closes, p.attributes, p.raw) for p in warc._Scanner(html)] == by_pattern(html)


def test_hostile_pages_take_time_by_their_length():
    for unit in ("<a href='", "<a href=\"'", "<a '\">", "<script '", "<", "<!", "<a ", "<!--", "'\"<b>", "<textarea>", "</script ", "<a b"):
        html = "x" + unit * (1_000_000 // len(unit))
        began = time.time()
        warc.Page(html, "http://h.example/")
        assert time.time() - began < 5, unit
    began = time.time()
    warc.Page("<a " + "b" * 1_000_000 + " href='x'>", "http://h.example/")
    assert time.time() - began < 2


def test_payloads_are_read_by_their_type(spark):
    head = "HTTP/1.1 200 OK\r\nContent-Type: {}\r\nX-A: b"
    rows = [(1, "r1", "http://h.example/", "d", head.format("text/html"), b"<p>a<b>c", "s"), (2, "r2", "http://h.example/", "d", head.format("text/plain; charset=latin-1"), b"a < b <p>\xe9", "s"),
            (3, "r3", "http://h.example/", "d", head.format("image/png"), b"\x89PNG<p>", "s"), (4, "r4", "http://h.example/", "d", "HTTP/1.1 200 OK", b"<p>x</p>", "s"),
            (5, "r5", "http://h.example/", "d", head.format("application/xhtml+xml"), b"<a href='q'>x</a>", "s"), (6, None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, record_id string, target_uri string, warc_date string, http_header string, payload binary, payload_digest string")
    got = {(r["page_id"], r["warc_type"]): r for r in warc.derive(df).collect()}
    assert {k[0]: r["block"] for k, r in got.items() if k[1] == "conversion"} == {1: "ac", 2: "a < b <p>é", 4: "x", 5: "x", 6: ""}
    assert {k[0] for k in got if k[1] == "metadata"} == {1, 2, 3, 4, 5, 6} and got[5, "metadata"]["n_links"] == 1
    assert "http-header-x-a: b\r\n" in got[3, "metadata"]["block"]


def plain_derivatives(page_id, url, html):
    """The two records of a page, formed anew from the specification's fields."""
    import base64
    import hashlib
    import html as entities
    from urllib.parse import urljoin

    sha1 = lambda b: "sha1:" + base64.b32encode(hashlib.sha1(b).digest()).decode()
    url, html = url or "", html or ""
    text, at, title, lang, links = [], 0, "", "", []

    def value(attributes, name):
        for m in re.finditer(r"([^\s=/>\"']+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", attributes):
            if m[1].lower() == name:
                return entities.unescape(next(x for x in m.groups()[1:] if x is not None))
        return ""

    for start, end, name, closes, attributes, raw in by_pattern(html):
        text.append(entities.unescape(html[at:start]))
        at = end
        if name == "title" and raw is not None and not title:
            title = " ".join(entities.unescape(raw).split())
        if name == "textarea" and raw is not None:
            text.append(entities.unescape(raw))
        if name == "html" and not closes:
            lang = lang or value(attributes, "lang")
        key = {"a": "href", "area": "href", "link": "href", "img": "src", "script": "src", "iframe": "src", "form": "action"}.get(name)
        if key and not closes and value(attributes, key).strip():
            links.append(("".join(urljoin(url, value(attributes, key).strip()).split()), f"{name}/@{key}"))
        if raw is None:
            text.append("\n" if name in warc._BLOCKS else "\t" if name in ("td", "th") and not closes else "")
    text.append(entities.unescape(html[at:]))
    lines = [re.sub(r"[^\S\n]+", " ", x).strip() for x in "".join(text).replace("\r", "\n").split("\n")]
    body = html.encode()
    meta = [("http-status", "200"), ("http-header-content-type", "text/html; charset=utf-8"), ("http-header-content-length", str(len(body))), ("title", title),
            ("languages-html", lang), ("payload-digest", sha1(body)), *[("outlink", f"{a} {b}") for a, b in links]]
    blocks = {"metadata": "".join(f"{k}: {' '.join(v.split())}\r\n" for k, v in meta if v), "conversion": "\n".join(x for x in lines if x)}
    return [(page_id, kind, url, sha1(body), sha1(b.encode()), len(links), b) for kind, b in blocks.items()]


def test_query_equals_plain_records(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()
    got = warc.query(spark, SF_SMALL).collect()
    want = [x for p in pages for x in plain_derivatives(p["page_id"], p["url"], p["html"])]
    assert sorted((r["page_id"], r["warc_type"], r["target_uri"], r["payload_digest"], r["block_digest"], r["n_links"], r["block"]) for r in got) == sorted(want)
    sources = {r["page_id"]: r["record_id"] for r in warc.pages_to_responses(spark.read.parquet(f"{SF_SMALL}/pages.parquet")).collect()}
    assert all(r["refers_to"] == sources[r["page_id"]] for r in got) and len({r["record_id"] for r in got}) == len(got)


def test_deduplication_in_several_batches(spark, monkeypatch, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    docs = docs.unionByName(docs.limit(60)).repartition(6)
    path = str(tmp_path / "docs")
    docs.write.parquet(path)
    docs = spark.read.parquet(path)
    columns = lambda: sorted(map(tuple, exact_dedup.exact_groups(docs).select("doc_id", "keep_id", "group_size", "kept").collect()))
    monkeypatch.setattr(exact_dedup, "TRIGGER_BYTES", 1 << 40)
    want = columns()
    batches = []
    run = exact_dedup.run_stream

    def counted(spark, feed_path, schema):
        from pathlib import Path

        state = run(spark, feed_path, schema)
        newest = max(Path(exact_dedup.scratch_path(spark, "x")[5:] if exact_dedup.scratch_path(spark, "x").startswith("file:") else exact_dedup.scratch_path(spark, "x")).parent.glob("dedup-state-*"),
                     key=lambda p: p.stat().st_mtime)
        batches.append(len([p for p in (newest / "commits").iterdir() if p.name.isdigit()]))
        return state

    monkeypatch.setattr(exact_dedup, "run_stream", counted)
    monkeypatch.setattr(exact_dedup, "TRIGGER_BYTES", 1)
    assert columns() == want and batches[0] >= 3
