"""WARC derivatives: metadata and plain-text conversion records of responses.

``pages_to_responses`` makes response records of raw pages; ``derive`` gives for each
response a metadata record (``application/warc-fields``: title, language, the source's
HTTP headers, its digest, its links as absolute URLs) and a conversion record (plain
text).  Both name the response in ``WARC-Refers-To`` and keep its target URI, date and
payload digest.  Identifiers are derived from the contents, so a task that runs twice
writes the same records.  ``write`` stores records as WARC files by Spark's own text
writer.

Defined results: a null URL counts as the empty URL, null HTML or payload as empty
(with the digest of the empty string, no links and an empty text); repeated rows give
equal records; unclosed comments and scripts run to the end; a base URL that cannot be
parsed leaves links as they are; a payload whose header names another text type is its
own conversion and has no links, one that is no text (an image) has no conversion; a header
without a type means HTML; very long pages are read in time that grows with their length, whatever
quotes and brackets they leave open; an empty table gives no record; extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm._common import pick, ship, table

#: No crawl time is known for raw pages; a caller who knows it passes it.
DATE = "1970-01-01T00:00:00Z"
CRLF = "\r\n"
_RAW = re.compile(r"<(script|style|noscript|template|title|textarea)\b", re.I)
_RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style", "noscript", "template", "title", "textarea")}
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
_SPECIAL = re.compile(r"['\">]")
#: A name, with its value if it has one: names alone are read too, so that a long one is passed over at once.
_ATTRIBUTE = re.compile(r"([^\s=/>\"']++)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]++)))?")
_LINKS = {"a": "href", "area": "href", "link": "href", "img": "src", "script": "src", "iframe": "src", "form": "action"}
#: Elements that begin a new line of the text.
_BLOCKS = frozenset("address article aside blockquote body br dd div dl dt fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr html "
                    "li main nav ol p pre section table tbody tfoot thead tr ul".split())
_BLANKS = re.compile(r"[^\S\n]+")


def sha1_digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode("ascii")


def record_id(*parts: bytes) -> str:
    h = hashlib.sha256()
    for p in parts:
        h.update(len(p).to_bytes(8, "big") + p)
    return f"<urn:uuid:{uuid.UUID(bytes=h.digest()[:16], version=5)}>"


@dataclass
class Part:
    """A stretch of markup: ``start`` to ``end``; the element's name if it is a whole tag, whether it closes,
    its attributes, and for an element whose content is raw text that content."""

    start: int
    end: int
    name: str = ""
    closes: bool = False
    attributes: str = ""
    raw: str | None = None


class _Scanner:
    """The tags, comments and raw elements of a page in one pass.  Time grows with the page's length
    whatever it holds: the next ``>`` is looked for once, and a place outside quotes from which no
    tag ends is remembered, so that the next unclosed tag which gets there stops."""

    def __init__(self, html: str):
        self.html = html
        self._next_close = -2
        self._hopeless: set[int] = set()

    def _close(self, at: int) -> int:
        """The first ``>`` from ``at`` on, -1 if none."""
        if self._next_close != -1 and self._next_close < at:
            self._next_close = self.html.find(">", at)
        return self._next_close

    def _tag_end(self, at: int) -> int:
        """Behind the first ``>`` outside quotes from ``at`` on, -1 if none."""
        been = []
        while at not in self._hopeless:
            been.append(at)
            m = _SPECIAL.search(self.html, at)
            if m is None:
                break
            if m[0] == ">":
                return m.end()
            quote = self.html.find(m[0], m.end())
            if quote < 0:
                break
            at = quote + 1
        self._hopeless.update(been)
        return -1

    def __iter__(self) -> Iterator[Part]:
        html, at = self.html, 0
        while (at := html.find("<", at)) >= 0:
            if html.startswith("<!--", at):
                end = html.find("-->", at + 4)
                part = Part(at, len(html) if end < 0 else end + 3)
            elif self._close(at) < 0:  # nothing but comments can follow
                at = html.find("<!--", at)
                if at < 0:
                    return
                continue
            else:
                part = self._raw(at) or self._tag(at)
            if part is None:
                at += 1
            else:
                yield part
                at = part.end

    def _raw(self, at: int) -> Part | None:
        m = _RAW.match(self.html, at)
        begin = self._tag_end(m.end()) if m else -1
        if begin < 0:
            return None
        closing = _RAW_END[m[1].lower()].search(self.html, begin)
        last, end = (closing.start(), closing.end()) if closing else (len(self.html), len(self.html))
        return Part(at, end, m[1].lower(), False, self.html[m.end():begin - 1], self.html[begin:last])

    def _tag(self, at: int) -> Part | None:
        if self.html.startswith(("<!", "<?"), at):
            return Part(at, self._close(at) + 1)
        m = _TAG.match(self.html, at)
        if m is None:
            return None
        end = self._tag_end(m.end())
        if end >= 0:
            return Part(at, end, m[2].lower(), bool(m[1]), self.html[m.end():end - 1])
        return Part(at, self._close(at) + 1)


class Page:
    """Title, language, links and text of an HTML page, from one pass over its tags."""

    def __init__(self, html: str, base: str):
        self.title, self.lang, self.links = "", "", []
        out, at = [], 0
        for part in _Scanner(html):
            out.append(unescape(html[at:part.start]))
            at = part.end
            if part.raw is not None:
                if part.name == "title" and not self.title:
                    self.title = " ".join(unescape(part.raw).split())
                elif part.name == "textarea":
                    out.append(unescape(part.raw))
                elif part.name == "script":
                    self._link("script", part.attributes, base)
                continue
            if part.name and not part.closes:
                if part.name == "html":
                    self.lang = self.lang or self._attributes(part.attributes).get("lang", "")
                self._link(part.name, part.attributes, base)
            if part.name in _BLOCKS:
                out.append("\n")
            elif part.name in ("td", "th"):
                out.append("\t" if not part.closes else "")
        out.append(unescape(html[at:]))
        lines = (_BLANKS.sub(" ", x).strip() for x in "".join(out).replace("\r", "\n").split("\n"))
        self.text = "\n".join(x for x in lines if x)

    @staticmethod
    def _attributes(text: str) -> dict[str, str]:
        valued = ((m[1], next((x for x in m.groups()[1:] if x is not None), None)) for m in reversed(list(_ATTRIBUTE.finditer(text))))
        return {name.lower(): unescape(value) for name, value in valued if value is not None}

    def _link(self, name: str, attributes: str, base: str) -> None:
        key = _LINKS.get(name)
        target = self._attributes(attributes).get(key, "").strip() if key else ""
        if target:
            try:
                target = urljoin(base, target)
            except ValueError:
                pass
            self.links.append(("".join(target.split()), f"{name}/@{key}"))


def pages_to_responses(pages: DataFrame, date: str = DATE) -> DataFrame:
    """(page_id, record_id, target_uri, warc_date, http_header, payload, payload_digest)."""
    ship(pages.sparkSession)
    names = ["page_id", "record_id", "target_uri", "warc_date", "http_header", "payload", "payload_digest"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for page, url, html in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                url, body = url or "", (html.as_py() or "").encode("utf-8")
                header = CRLF.join(("HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}"))
                rows.append((page, record_id(str(page).encode(), url.encode(), body), url, date, header, body, sha1_digest(body)))
            types = [pa.int64()] + [pa.string()] * 4 + [pa.binary(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

    p = pick(pages, "page_id", "url", "html").select(F.col("page_id").cast("long"), "url", "html")
    return p.mapInArrow(run, "page_id long, record_id string, target_uri string, warc_date string, http_header string, payload binary, payload_digest string")


def _fields(header: str) -> list[tuple[str, str]]:
    pairs = (x.split(":", 1) for x in header.split(CRLF)[1:] if ":" in x)
    return [(k.strip(), v.strip()) for k, v in pairs]


def _charset(header: str) -> str:
    m = re.search(r"(?im)^content-type:.*?charset=[\"']?([\w.:-]+)", header)
    return m[1] if m else "utf-8"


def _kind(header: str) -> str:
    """How a payload is read, by its header's content type: ``html`` (also where none is named), ``text`` or
    ``other``."""
    m = re.search(r"(?im)^content-type:[^\S\r\n]*([^\s;]+)", header)
    kind = m[1].lower() if m else "text/html"
    return "html" if kind in ("text/html", "application/xhtml+xml") else "text" if kind.startswith("text/") else "other"


class _Bare:
    """What is told of a payload that is no HTML page."""

    title = lang = ""
    links: list = []

    def __init__(self, text: str | None):
        self.text = text


def derive(responses: DataFrame) -> DataFrame:
    """Two records a response, metadata alone for one that is neither HTML nor text: (page_id, warc_type, record_id, refers_to, target_uri,
    warc_date, content_type, payload_digest of the source, block_digest, n_links, block)."""
    ship(responses.sparkSession)
    names = ["page_id", "warc_type", "record_id", "refers_to", "target_uri", "warc_date", "content_type", "payload_digest", "block_digest", "n_links", "block"]
    types = [pa.int64()] + [pa.string()] * 8 + [pa.int64(), pa.string()]
    columns = ["page_id", "record_id", "target_uri", "warc_date", "http_header", "payload", "payload_digest"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for page, source, uri, date, header, payload, digest in zip(*(b.column(k).to_pylist() for k in range(7))):
                uri, header, payload = uri or "", header or "", payload or b""
                kind = _kind(header)
                try:
                    text = "" if kind == "other" else payload.decode(_charset(header), "replace")
                except LookupError:
                    text = payload.decode("utf-8", "replace")
                seen = Page(text, uri) if kind == "html" else _Bare(text if kind == "text" else None)
                status = header.split(CRLF)[0].split(" ")
                lines = [("http-status", status[1] if len(status) > 1 else "")] + [(f"http-header-{k.lower()}", v) for k, v in _fields(header)]
                lines += [("title", seen.title), ("languages-html", seen.lang), ("payload-digest", digest or "")]
                lines += [("outlink", f"{to} {how}") for to, how in seen.links]
                meta = "".join(f"{k}: {' '.join(v.split())}{CRLF}" for k, v in lines if v)
                for kind, form, block in (("metadata", "application/warc-fields", meta), ("conversion", "text/plain; charset=utf-8", seen.text)):
                    if block is None:
                        continue
                    data = block.encode("utf-8", "replace")
                    rows.append((page, kind, record_id(kind.encode(), (source or "").encode(), data), source, uri, date, form, digest,
                                 sha1_digest(data), len(seen.links), data.decode("utf-8")))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

    return responses.select(*columns).mapInArrow(
        run, "page_id long, warc_type string, record_id string, refers_to string, target_uri string, warc_date string, content_type string, "
             "payload_digest string, block_digest string, n_links long, block string")


def serialise(records: DataFrame) -> DataFrame:
    """(value): each derivative as the text of a WARC/1.1 record, without the two line
    ends that close it; a record's length counts bytes of UTF-8."""
    head = F.concat_ws(CRLF, F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), "warc_type"), F.concat(F.lit("WARC-Record-ID: "), "record_id"),
                       F.concat(F.lit("WARC-Refers-To: "), "refers_to"), F.concat(F.lit("WARC-Target-URI: "), "target_uri"),
                       F.concat(F.lit("WARC-Date: "), "warc_date"), F.concat(F.lit("WARC-Payload-Digest: "), "payload_digest"),
                       F.concat(F.lit("WARC-Block-Digest: "), "block_digest"), F.concat(F.lit("Content-Type: "), "content_type"),
                       F.concat(F.lit("Content-Length: "), F.octet_length("block").cast("string")))
    return records.select(F.concat(head, F.lit(CRLF * 2), F.col("block")).alias("value"))


def write(records: DataFrame, path: str) -> None:
    """One WARC file a partition, committed by Spark's writer."""
    serialise(records).write.option("lineSep", CRLF * 2).text(path)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(pages_to_responses(table(spark, sf_dir, "pages")))
