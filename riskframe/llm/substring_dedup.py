"""Substring deduplication: winnowed anchors, matches extended both ways.

A window is ``length`` consecutive words.  Seeds: of every run of ``length - seed + 1``
seed grams (``seed`` words each) the one with the least hash, the rightmost of ties,
is an anchor, so two documents that share a window share the anchor in it, at the same
place of the window.  Documents meet on the anchors' hash, sorted by id.  Extension:
an anchor carries a hash of each window it stands for (its words to the left and the
right up to ``length``); a window whose hash came with a smaller id under the same
anchor is a repeat.  Adjacent and overlapping repeats of a document are put together,
which gives its maximal repeats of ``length`` words or more.

An anchor's rows are read as a sorted stream in which only the first id of each of its
windows is kept, so no pairs are made, however many documents share a passage; and a
task sends a match that it can decide itself as decided, so a frequent passage does
not pile up in one partition.  An anchor that stands in many different windows (a
common phrase) is dealt by window instead, which splits its rows; a sample of the
documents tells which anchors are so frequent, and only the dealing depends on it.

Defined results: null text counts as no words; a document with fewer words than
``length`` has no window; only a document with a smaller id counts, so repeats inside
one document and repeated rows of one id remove nothing; a null id is greater than any
other and removes from no one; extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm._common import cut, hex_sha256, pick, ship, table

LENGTH, SEED = 13, 5
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Words whose hash one Python worker remembers before it starts afresh.
WORD_CACHE = 300_000
#: Bytes of a window's hash that travel; the anchor's 8 bytes stand beside them.
WINDOW_BYTES = 5
#: Anchors with their windows one task remembers before it starts afresh.
SEEN = 150_000
#: One document in so many is looked at for frequent anchors.
ONE_IN = 64
#: Different window sets of an anchor in that sample above which it is dealt by window;
#: more than a ``MOST``-th of all in a large sample, so the list is of ``MOST`` hashes at most.
FREQUENT, MOST = 64, 2_000_000
#: Words handled at once in a text of any length.
BLOCK = 1 << 20


class _WordHash(dict):
    def __missing__(self, word: str) -> int:
        import xxhash

        h = xxhash.xxh64_intdigest(word.encode("utf-8"))
        if len(self) >= WORD_CACHE:
            self.clear()
        self[word] = h
        return h


_word_hash = _WordHash()


def _mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: spreads the polynomial sums over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _grams(h: np.ndarray, k: int, base: int) -> np.ndarray:
    """Hash of each ``k`` consecutive words."""
    n = len(h) - k + 1
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * np.uint64(base) + h[j:j + n]
    return _mixed(out)


def anchors(words: list[str], length: int = LENGTH, seed: int = SEED) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For blocks of a text: anchor hashes, first window of each, number of windows, and
    the windows' hashes one after the other.  Every window belongs to one anchor."""
    span = length - seed + 1
    for at in range(0, max(len(words) - length + 1, 0), BLOCK):
        block = words[at:at + BLOCK + length - 1]
        h = np.fromiter(map(_word_hash.__getitem__, block), np.uint64, len(block))
        grams = _grams(h, seed, 0x9E3779B97F4A7C15)
        windows = _grams(h, length, 0xD6E8FEB86659FD93)
        runs = np.lib.stride_tricks.sliding_window_view(grams, span)
        anchor = np.arange(len(runs)) + span - 1 - np.argmin(runs[:, ::-1], axis=1)
        first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        yield grams[anchor[first]], first + at, np.diff(np.append(first, len(windows))), windows


def _by_window(hot: np.ndarray, h: np.ndarray, start: np.ndarray, n: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(h, start, n) with a row for each window of the anchors in ``hot`` (sorted); such
    a row's hash is that of anchor and window together."""
    at = np.minimum(np.searchsorted(hot, h), len(hot) - 1)
    split = hot[at] == h
    if not split.any():
        return h, start, n
    rows = np.where(split, n, 1)
    row = np.repeat(np.arange(len(h)), rows)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(rows) - rows, rows)
    of_row = (np.cumsum(n) - n)[row] + nth
    return np.where(split[row], _mixed(h[row] ^ windows[of_row]), h[row]), start[row] + nth, np.where(split[row], 1, n[row])


def _anchor_rows(docs: DataFrame, length: int, seed: int, hot: np.ndarray | None = None) -> DataFrame:
    """(h, doc_id, text_hash, start, n, windows): windows are ``WINDOW_BYTES`` each;
    anchors in ``hot`` have a row and a hash for each window.

    A task sends an anchor with the same windows again only for an id below all it has
    seen; for others the match is decided on the spot, and a row with their ``n`` windows
    and no hashes goes where their id is dealt.  So an anchor in a third of all documents
    costs its partition one row a task, not one a document."""
    shared = docs.sparkSession.sparkContext.broadcast(hot) if hot is not None and len(hot) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[tuple[int, bytes], int] = {}
        for batch in batches:
            for doc, text, text_hash in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                for h, start, n, windows in anchors(WORD.findall(text.as_py() or ""), length, seed):
                    if shared is not None:
                        h, start, n = _by_window(shared.value, h, start, n, windows)
                    data = windows.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :WINDOW_BYTES].tobytes()
                    offsets = (np.append(0, np.cumsum(n)) * WINDOW_BYTES).tolist()
                    if len(least) > SEEN:
                        least.clear()
                    values = [data[x:y] for x, y in zip(offsets, offsets[1:])]
                    known = np.zeros(len(h), bool)
                    for i, (key, value) in enumerate(zip(h.tolist(), values)):
                        before = least.get((key, value))
                        if before is not None and (doc is None or before < doc):
                            known[i] = True
                            values[i] = b""
                        elif doc is not None:
                            least[key, value] = doc
                    h = np.where(known, _mixed(np.full(1, (doc or 0) % (1 << 63), np.uint64) + start.astype(np.uint64)), h)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h.view(np.int64)), pa.array([doc] * len(h), pa.int64()), pa.array(np.full(len(h), text_hash, np.int32)),
                         pa.array(start.astype(np.int32)), pa.array(np.where(known, n, 0).astype(np.int32)), pa.array(values, pa.binary())],
                        ["h", "doc_id", "text_hash", "start", "n", "windows"])

    return docs.mapInArrow(_gathered(run), "h long, doc_id long, text_hash int, start int, n int, windows binary")


def frequent_anchors(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> np.ndarray:
    """Sorted hashes of the anchors that stand in many different windows.  Copies of a
    passage have equal windows and count once: tasks decide those by themselves."""
    sample = docs.filter(F.pmod(F.xxhash64("doc_id", "text_hash", F.lit("anchor sample")), F.lit(ONE_IN)) == 0)
    different = _anchor_rows(sample, length, seed).filter("n = 0").select("h", F.xxhash64("windows").alias("w")).distinct()
    counts = cut(different.groupBy("h").agg(F.count("*").alias("n")))
    total = counts.agg(F.sum("n")).first()[0] or 0
    listed = counts.filter(F.col("n") > max(FREQUENT, total // MOST)).select("h").toPandas()  # at most MOST rows
    return np.sort(listed["h"].to_numpy(np.int64).view(np.uint64))


def _gathered(run, rows: int = 50_000):
    """Put the small batches a function yields together."""

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in run(batches):
            held.append(b)
            n += b.num_rows
            if n >= rows:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, n = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return together


def _repeats_in_stream(length: int):
    """Rows sorted by anchor and id -> (doc_id, text_hash, first word, end word)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_h, seen = None, {}  # the anchor that may go on in the next batch; first id of its windows
        for batch in batches:
            if not batch.num_rows:
                continue
            h = batch.column(0).to_numpy(zero_copy_only=False)
            none = np.asarray(batch.column(1).is_null())
            doc = batch.column(1).fill_null(0).to_numpy(zero_copy_only=False)
            border = np.flatnonzero(h[1:] != h[:-1]) + 1
            first, last = np.append(0, border), np.append(border, len(h))
            group = np.repeat(np.arange(len(first)), last - first)
            goes_on = open_h is not None and h[0] == open_h
            if not goes_on:
                seen = {}
            useful = (last - first > 1)[group]
            useful |= (group == len(first) - 1) | (goes_on & (group == 0))
            rows = np.flatnonzero(useful)
            column = batch.column(5).take(pa.array(rows))
            sizes = np.diff(np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(rows) + 1]) // WINDOW_BYTES
            packed = b"".join(column.to_pylist())
            codes = np.zeros((len(packed) // WINDOW_BYTES, 8), np.uint8)
            codes[:, :WINDOW_BYTES] = np.frombuffer(packed, np.uint8).reshape(-1, WINDOW_BYTES)
            codes = codes.view(np.uint64).ravel()
            row = np.repeat(rows, sizes)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            order = np.lexsort((row, codes, group[row]))  # rows come by id, so the first of a run is the smallest
            g, c, r = group[row][order], codes[order], row[order]
            new = np.append(True, (g[1:] != g[:-1]) | (c[1:] != c[:-1])) if len(g) else np.zeros(0, bool)
            head = r[np.flatnonzero(new)][np.cumsum(new) - 1] if len(g) else r
            repeat = ~none[head] & (none[r] | (doc[head] < doc[r]))
            if goes_on:
                for k in np.flatnonzero(g == 0).tolist():
                    before = seen.get(int(c[k]))
                    repeat[k] |= before is not None and (none[r[k]] or before < doc[r[k]])
            if not goes_on or len(first) > 1:
                seen = {}
            for k in np.flatnonzero(new & (g == len(first) - 1)).tolist():
                if not none[r[k]]:
                    seen.setdefault(int(c[k]), int(doc[r[k]]))
            open_h = h[-1]
            decided = batch.filter(pa.array(batch.column(4).to_numpy(zero_copy_only=False) > 0))
            if decided.num_rows:
                begin = decided.column(3).to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([decided.column(1), decided.column(2), decided.column(3), pa.array(
                    (begin + decided.column(4).to_numpy(zero_copy_only=False) - 1 + length).astype(np.int32))], ["doc_id", "text_hash", "first", "end"])
            hit = np.zeros(len(row), bool)
            hit[order] = repeat
            if hit.any():
                # neighbouring windows of one anchor row become one stretch
                at, who = nth[hit], row[hit]
                cut = np.append(True, (who[1:] != who[:-1]) | (at[1:] != at[:-1] + 1))
                begin = np.flatnonzero(cut)
                end = np.append(begin[1:], len(at)) - 1
                who = who[begin]
                start = batch.column(3).to_numpy(zero_copy_only=False)[who]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).take(pa.array(who)), batch.column(2).take(pa.array(who)),
                     pa.array((start + at[begin]).astype(np.int32)), pa.array((start + at[end] + length).astype(np.int32))],
                    ["doc_id", "text_hash", "first", "end"])

    return run


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows are told apart by id and text, so repeated ids keep results of their own."""
    d = pick(docs, id_col, text_col)
    return d.select(d[id_col].cast("long").alias("doc_id"), F.coalesce(d[text_col], F.lit("")).alias("text")).withColumn("text_hash", F.hash("text"))


def stretches(docs: DataFrame, length: int = LENGTH, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, first, end): word ranges that repeat a smaller id's text."""
    ship(docs.sparkSession)
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = _keyed(docs, id_col, text_col).select("doc_id", "text", "text_hash")
    rows = _anchor_rows(keyed, length, seed, frequent_anchors(keyed, length, seed))
    dealt = rows.repartition(n, "h").sortWithinPartitions("h", F.col("doc_id").asc_nulls_last())
    return dealt.mapInArrow(_repeats_in_stream(length), "doc_id long, text_hash int, first int, end int")


def maximal(ranges: np.ndarray) -> np.ndarray:
    """Overlapping or touching (first, end) ranges put together."""
    if not len(ranges):
        return ranges.reshape(0, 2)
    ranges = ranges[np.argsort(ranges[:, 0], kind="stable")]
    reach = np.maximum.accumulate(ranges[:, 1])
    begin = np.append(True, ranges[1:, 0] > reach[:-1])
    return np.stack([ranges[begin, 0], reach[np.append(np.flatnonzero(begin)[1:], len(ranges)) - 1]], axis=1)


def remove_repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text",
                   with_text: bool = False) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_removed, kept_sha256, repeats
    (maximal repeats as word ranges) and, if asked for, the kept text."""
    ranges = (stretches(docs, length, seed, id_col, text_col).groupBy("doc_id", "text_hash")
              .agg(F.collect_list("first").alias("firsts"), F.collect_list("end").alias("ends"))
              .withColumnsRenamed({"doc_id": "_d", "text_hash": "_t"}))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press = zstandard.ZstdCompressor(level=3).compress
        for b in batches:  # texts cross the shuffle compressed
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([press(t.as_py().encode("utf-8")) for t in b.column(2)], pa.binary())],
                                             ["doc_id", "text_hash", "z"])

    texts = _keyed(docs, id_col, text_col).select("doc_id", "text_hash", "text").mapInArrow(packed, "doc_id long, text_hash int, z binary")
    both = texts.join(ranges, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_hash") == F.col("_t")), "left").select("doc_id", "z", "firsts", "ends")
    schema = f"{id_col} long, n_words long, n_removed long, kept_sha256 string, repeats array<struct<first:int,end:int>>" + (", kept string" if with_text else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpress = zstandard.ZstdDecompressor().decompress
        for b in batches:
            out = []
            for doc, z, firsts, ends in zip(b.column(0).to_pylist(), b.column(1), b.column(2), b.column(3)):
                words = WORD.findall(unpress(z.as_py()).decode("utf-8"))
                spans = maximal(np.array([firsts.values.to_numpy(), ends.values.to_numpy()]).T) if firsts.is_valid else np.zeros((0, 2), int)
                kept, at = [], 0
                for x, y in spans.tolist():
                    kept += words[at:x]
                    at = y
                kept += words[at:]
                text = " ".join(kept)
                out.append({id_col: doc, "n_words": len(words), "n_removed": len(words) - len(kept), "kept_sha256": hex_sha256(text.encode("utf-8")),
                            "repeats": [{"first": x, "end": y} for x, y in spans.tolist()], **({"kept": text} if with_text else {})})
            fields = [(id_col, pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()),
                      ("repeats", pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())])))] + ([("kept", pa.string())] if with_text else [])
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema(fields))

    return both.mapInArrow(run, schema)


SQL = rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
win AS (SELECT doc_id, i, list_slice(words, i + 1, i + {LENGTH}) AS g FROM (SELECT doc_id, words, unnest(range(0, len(words) - {LENGTH} + 1)) AS i FROM w)),
hit AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS first_doc FROM win) WHERE first_doc < doc_id),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM hit, range(0, {LENGTH}) r(j)),
one AS (SELECT doc_id, unnest(words) AS word, unnest(range(0, len(words))) AS p FROM w),
kept AS (SELECT o.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY o.p) AS t FROM one o ANTI JOIN gone g ON o.doc_id = g.doc_id AND o.p = g.p GROUP BY o.doc_id)
SELECT w.doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept k ON w.doc_id = k.doc_id
"""


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")
