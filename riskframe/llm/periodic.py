"""Periodic runs by a dictionary of basic factors.

A text's words become numbers, and for each power of two ``2^k`` every stretch of ``2^k``
words gets a name, equal for equal stretches: the name of a longer one is that of its two
halves.  Occurrences of one stretch that start within its own length of each other, that is
inside a window of twice its length, form an arithmetic progression whose step is the
period of the run they lie in.  So wherever a stretch has its successor at distance ``q`` and
that one again, ``q`` is proposed; proposals side by side are one run, which is extended both
ways and kept once, however many levels propose it.

A run of period ``q`` and of ``MIN_TURNS * q`` words or more is proposed at the level with
``2^(k-1) < q <= 2^k``: its stretches of ``2^k`` words are no shorter than the period, so the next
occurrence is exactly ``q`` on, and three occurrences fit.  Only stretches whose halves both
recur can recur, so a level reads what the last one left; a text without repeats is done
after a few words' levels.

Documents are independent: a task names the stretches of many small ones together, each
set apart by a number of its own.  Nothing is shuffled.

Defined results: null and empty texts have no words and no run; a null id counts as the
empty text in the rule that plants repeats; repeated rows are answered each; very long texts
are read whole, alone in their turn; of runs of equal length the one with the smallest start,
then period is reported; an empty table gives no row; extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from riskframe.llm._common import hex_sha256, pick, ship, table

#: Fewest words and turns of a run.
MIN_WORDS, MIN_TURNS = 6, 4
#: Words named together.
AT_ONCE = 200_000


# ------------------------------------------------------------------ runs
def _names(pairs: np.ndarray) -> np.ndarray:
    """Equal numbers for equal entries, from 0."""
    return np.unique(pairs, return_inverse=True)[1]


def _recurring(names: np.ndarray) -> np.ndarray:
    return np.bincount(names)[names] > 1


def runs(ids: np.ndarray, min_words: int = MIN_WORDS, min_turns: int = MIN_TURNS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of the runs in ``ids``, by start, then period.  ``min_turns`` is 4 or more: fewer
    would leave runs in which no stretch recurs twice."""
    n = len(ids)
    at, names, size = np.arange(n), _names(ids) if n else ids, 1
    starts, ends, periods = [], [], []
    while len(at):
        keep = _recurring(names)
        at, names = at[keep], names[keep]
        if not len(at):
            break
        order = np.argsort(names, kind="stable")
        here, there = order[:-1], order[1:]
        step = np.zeros(len(at), np.int64)  # to the successor, 0: none within the stretch's length
        gap = at[there] - at[here]
        step[here] = np.where((names[here] == names[there]) & (gap <= size), gap, 0)
        spread = np.zeros(n + 1, np.int64)
        spread[at] = step
        some = at[step > 0]
        q = spread[some]
        twice = spread[some + q] == q  # three occurrences in progression
        some, q = some[twice], q[twice]
        if len(some):
            new = np.ones(len(some), bool)
            new[1:] = (some[1:] != some[:-1] + 1) | (q[1:] != q[:-1])
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(some)) - 1
            starts.append(some[first])
            ends.append(some[last] + size + 2 * q[first])
            periods.append(q[first])
        # the next level's stretches: both halves recur
        place = np.full(n + size, -1, np.int64)
        place[at] = names
        second = place[at + size] if len(at) else at
        both = second >= 0
        at, pairs = at[both], names[both] * (int(names.max()) + 1) + second[both]
        names, size = _names(pairs) if len(at) else pairs, 2 * size
    if not starts:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    found = np.unique(np.stack([np.concatenate(starts), np.concatenate(ends), np.concatenate(periods)], axis=1), axis=0)
    extended = np.array([_extend(ids, *row) for row in found.tolist()], np.int64)
    extended = np.unique(extended[extended[:, 1] >= np.maximum(min_words, min_turns * extended[:, 2])], axis=0)
    extended = extended[np.lexsort((extended[:, 2], extended[:, 0]))]
    return extended[:, 0], extended[:, 1], extended[:, 2]


def _extend(ids: np.ndarray, start: int, end: int, period: int) -> tuple[int, int, int]:
    """(start, length, period) after growing both ways as far as the period holds."""
    while start > 0 and ids[start - 1] == ids[start - 1 + period]:
        start -= 1
    while end < len(ids) and ids[end] == ids[end - period]:
        end += 1
    return start, end - start, period


# ------------------------------------------------------------------ documents
def planted(n: int, doc_id: int | None) -> np.ndarray | None:
    """For the query's contract: which original word stands at each place, None where all stay."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    return np.where(at < a, at, a + (at - a) % p)


def _collapsed(ids: np.ndarray, found: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """Which words stay: all but those after the first period of a run."""
    start, length, period = found
    edge = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edge, start + period, 1)
    np.add.at(edge, start + length, -1)
    return np.cumsum(edge[:-1]) == 0


def _together(words: list[list[bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The runs of each text of ``words``, found in one go: a number of its own stands after each text."""
    number: dict[bytes, int] = {}
    size = np.fromiter(map(len, words), np.int64, len(words))
    begin = np.cumsum(size + 1) - size - 1
    ids = np.zeros(int((size + 1).sum()), np.int64)
    for at, text in zip(begin.tolist(), words):
        ids[at:at + len(text)] = [number.setdefault(w, len(number)) for w in text]
    ids[begin + size] = len(number) + np.arange(len(words))
    start, length, period = runs(ids)
    edge = np.searchsorted(start, np.append(begin, len(ids)))
    for i, at in enumerate(begin.tolist()):
        mine = slice(edge[i], edge[i + 1])
        yield start[mine] - at, length[mine], period[mine]


COLUMNS = [("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()), ("exponent_milli", pa.int64()),
           ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())]


def _answers(texts: list[list[bytes]]) -> Iterator[tuple]:
    for words, found in zip(texts, _together(texts)):
        start, length, period = (x.tolist() for x in found)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in zip(start, length, period))
        kept = words
        top = (None,) * 4
        if start:
            stays = _collapsed(np.empty(len(words)), found)
            kept = [w for w, stay in zip(words, stays.tolist()) if stay]
            n, s, q = max(zip(length, (-x for x in start), (-x for x in period)))
            top = -s, n, -q, 1000 * n // -q
        yield len(start), *top, hex_sha256(listed.encode()), hex_sha256(b" ".join(kept))


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rearrange=None) -> DataFrame:
    """Per row: id, ``n_runs``, the longest run's ``start``, ``length``, ``period`` and ``exponent_milli``,
    ``runs_sha256`` (all runs) and ``collapsed_sha256`` (the text with one period of each run).
    ``rearrange(n, id)`` may give the order in which the words are read."""
    ship(docs.sparkSession)
    names = {"bigint": "long"}
    schema = ", ".join([f"{id_col} {docs.schema[id_col].dataType.simpleString()}"]
                       + [f"{name} {'string' if kind == pa.string() else names['bigint']}" for name, kind in COLUMNS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size = [], [], 0

        def answered() -> pa.RecordBatch:
            rows = list(zip(*_answers(texts)))
            columns = [pa.array(ids, kind_of_id)] + [pa.array(x, kind) for x, (_, kind) in zip(rows, COLUMNS)]
            return pa.RecordBatch.from_arrays(columns, [id_col, *[name for name, _ in COLUMNS]])

        for batch in batches:
            kind_of_id = batch.schema.field(0).type
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = (text.as_py() or "").encode().split()  # splits at the contract's white space exactly
                order = rearrange(len(words), doc_id) if rearrange else None
                words = words if order is None else [words[i] for i in order.tolist()]
                if texts and size + len(words) > AT_ONCE:
                    yield answered()
                    ids, texts, size = [], [], 0
                ids.append(doc_id)
                texts.append(words)
                size += len(words)
        if texts:
            yield answered()

    return pick(docs, id_col, text_col).mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_runs(table(spark, sf_dir, "documents"), rearrange=planted)


#: Brute force: pairs of equal words at each distance, stretches of such pairs, the least period of each stretch.
SQL = f"""
WITH texts AS (
  SELECT row_number() OVER () AS row, doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS original,
         list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), ''), ''), lambda c: unicode(c)::BIGINT) AS bytes
  FROM documents),
hashed AS (
  SELECT row, doc_id, original, len(original) AS n, xor(4294967295, list_reduce(list_prepend(4294967295, list_filter(bytes, lambda b: b >= 0)),
         lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)),
           lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))) AS h
  FROM texts),
placed AS (SELECT *, h // 10 AS g, (h // 10) % greatest(n, 1) AS a FROM hashed),
read AS (
  SELECT row, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
         THEN list_transform(range(n), lambda i: original[CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END + 1])
         ELSE original END AS words FROM placed),
spread AS (SELECT row, n, unnest(words) AS word, unnest(range(n)) AS i FROM read),
equal AS (SELECT a.row, b.i - a.i AS q, a.i FROM spread a JOIN spread b ON a.row = b.row AND a.word = b.word AND b.i > a.i AND b.i - a.i <= a.n // {MIN_TURNS}),
often AS (SELECT row, q FROM equal GROUP BY row, q HAVING count(*) >= greatest({MIN_TURNS - 1} * q, {MIN_WORDS} - q)),
stretches AS (
  SELECT row, q, min(i) AS start, count(*) + q AS length
  FROM (SELECT row, q, i, i - row_number() OVER (PARTITION BY row, q ORDER BY i) AS island FROM equal SEMI JOIN often USING (row, q))
  GROUP BY row, q, island HAVING count(*) + q >= greatest({MIN_WORDS}, {MIN_TURNS} * q)),
runs AS (
  SELECT * FROM stretches s WHERE NOT EXISTS (
    SELECT 1 FROM stretches t WHERE t.row = s.row AND t.q < s.q AND t.start <= s.start AND t.start + t.length >= s.start + s.length)),
listed AS (
  SELECT row, count(*) AS n_runs, arg_max(struct_pack(start, length, q), (length, -start, -q)) AS top,
         string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS runs
  FROM runs GROUP BY row),
gone AS (SELECT DISTINCT row, unnest(range(start + q, start + length)) AS i FROM runs),
kept AS (SELECT row, string_agg(word, ' ' ORDER BY i) AS kept FROM spread ANTI JOIN gone USING (row, i) GROUP BY row)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, top.start AS start, top.length AS length, top.q AS period, 1000 * top.length // top.q AS exponent_milli,
       sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM read LEFT JOIN listed USING (row) LEFT JOIN kept USING (row)
"""
