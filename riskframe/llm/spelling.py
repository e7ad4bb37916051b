"""Spelling variants: k-d trees over letter-count vectors.

Words of one edit (a letter inserted, deleted or replaced) differ by at most two in the L1
distance of their letter counts.  For a pair of lengths the sides are known: a replacement
adds one letter and takes one, an insertion adds one and takes none.  So for each word
length a k-d tree over the count vectors is searched with the words of that length and with
those one letter shorter; a box is left out when the word would have to gain or lose more
letters to get into it.  What remains is compared letter by letter.

The tree is spread over the cluster.  Its upper levels are built from a bounded sample of
the vocabulary (``SAMPLE`` words) and only deal: every word goes to the cell its vector lies
in, and as a query to each cell its box search reaches, so no pair is lost whatever the
sample.  A cell with more words or queries than ``CELL`` is dealt in blocks, each block of
its words with each block of its queries, so a task holds two bounded blocks.  Within a task
the lower levels are built from all words of the block and searched with all queries at once.

Letters outside a-z share ``OTHER`` dimensions and counts are told apart up to ``MOST``: both
only shorten distances, so nothing near is left out.

Defined results: null texts have no words; a null id counts as the empty text in the rule
that deletes letters; repeated rows count each time; very long words are compared whole; ties
of frequency go to the word first in code-point order; an empty table gives no row; extra
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm._common import cut, pick, ship, table

#: Fewest letters and occurrences of a word; a form is at least so many times as frequent.
MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5
#: One run in so many, by its hash, loses a letter.
ONE_IN = 199
LETTERS = "A-Za-z\\u00C0-\\u00FF"
#: Words, about, from which the dealing cells are made; words or queries of a cell that one task takes.
SAMPLE, CELL = 20_000, 8_000
#: Fewest sample words in a dealing cell, most words in a leaf of a task's tree.
FEWEST, LEAF = 8, 24
#: Dimensions of the letters outside a-z; greatest count that is told apart.
OTHER, MOST = 6, 4
DIMS = 26 + OTHER
#: Letters compared at once in a task.
COMPARE = 1 << 22
#: Parts of a root's followers.
SALTS = 16


# ------------------------------------------------------------------ words
def _lower(text: Column) -> Column:
    """A-Z alone in lower case."""
    ascii_only = F.length(text) == F.octet_length(text)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, upper, lower))


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", one_in: int = ONE_IN, min_length: int = MIN_LENGTH,
                min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): the words of at least ``min_length`` letters that occur ``min_count`` times,
    after one run in ``one_in`` has lost a letter.  Runs too short to count are passed over."""
    runs = F.regexp_extract_all(_lower(F.col("text")), F.lit(f"[{LETTERS}]{{{min_length},}}"), F.lit(0))
    text = pick(docs, id_col, text_col).toDF("id", "text").filter("text is not null")
    runs = text.select(F.coalesce(F.col("id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    runs = runs.select("run", F.crc32(F.concat_ws(":", "id", "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    word = F.when(F.col("h") % one_in == 0, F.concat(F.left("run", at), F.substr("run", at + 2))).otherwise(F.col("run"))
    words = runs.select(word.alias("word")).filter(F.length("word") >= min_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= min_count)


# ------------------------------------------------------------------ vectors and trees
def vectors(codes: np.ndarray) -> np.ndarray:
    """Letter counts of words of one length, ``codes`` holding a word's letters as Latin-1 in each row:
    two rows of 64-bit numbers, a column a word.  A count is written as that many set bits, ``MOST``
    at most (a lower bound of distances), so the bits that differ are the L1 distance, and a
    box of least and greatest counts is the AND and the OR of its members."""
    dim = np.where((codes >= 97) & (codes < 123), codes - 97, 26 + codes % OTHER).astype(np.int64)
    n = len(codes)
    counts = np.bincount((np.arange(n)[:, None] * DIMS + dim).ravel(), minlength=n * DIMS).reshape(n, DIMS)
    flags = np.concatenate([counts > k for k in range(MOST)], axis=1)
    return np.ascontiguousarray(np.packbits(flags, axis=1, bitorder="little").view(np.uint64).T)


def _flags(points: np.ndarray) -> np.ndarray:
    """A row a word, a column a bit: whether letter ``column % DIMS`` occurs more than ``column // DIMS`` times."""
    return np.unpackbits(np.ascontiguousarray(points.T).view(np.uint8), axis=1, bitorder="little")


def _best_split(flags: np.ndarray) -> int | None:
    """The bit that cuts the words most evenly: a letter, and a count at its median."""
    ones = flags.sum(axis=0, dtype=np.int64)
    even = np.minimum(ones, len(flags) - ones)
    bit = int(even.argmax())
    return bit if even[bit] else None


def _bits_of(letter: int, levels: range) -> np.ndarray:
    """The two numbers that have the bits of a letter at some levels."""
    out = np.zeros(2, np.uint64)
    for k in levels:
        out[(k * DIMS + letter) // 64] |= np.uint64(1) << np.uint64((k * DIMS + letter) % 64)
    return out


def _differ(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """By how many letters ``a`` has more than ``b``; either may be a box's two numbers."""
    return np.bitwise_count(a[0] & ~b[0]) + np.bitwise_count(a[1] & ~b[1])


def _reach(queries: np.ndarray, low: np.ndarray, high: np.ndarray, gain: int, loss: int) -> np.ndarray:
    """Which queries get into the box by ``gain`` more letters and ``loss`` fewer at most."""
    return (_differ(low, queries) <= gain) & (_differ(queries, high) <= loss)


@dataclass
class Cells:
    """The dealing levels for one word length: splits by node, leaves numbered from 0."""

    split: list = field(default_factory=list)  # per node: (bit, node below, node above) or the leaf's number
    leaves: int = 0

    @classmethod
    def of(cls, points: np.ndarray, per_cell: float) -> Cells:
        cells, flags = cls(), _flags(points)

        def grow(rows: np.ndarray) -> int:
            node = len(cells.split)
            cells.split.append(None)
            bit = _best_split(flags[rows]) if len(rows) > max(per_cell, FEWEST) else None
            if bit is None:
                cells.split[node] = cells.leaves
                cells.leaves += 1
            else:
                above = flags[rows, bit] == 1
                cells.split[node] = (bit, grow(rows[~above]), grow(rows[above]))
            return node

        grow(np.arange(points.shape[1]))
        return cells

    def deal(self, points: np.ndarray, gain: int, loss: int) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, rows of ``points`` that reach it); with no gain and no loss, the leaf each lies in."""
        stack = [(0, np.arange(points.shape[1]), np.zeros(2, np.uint64), ~np.zeros(2, np.uint64))]
        while stack:
            node, rows, low, high = stack.pop()
            rows = rows[_reach(points[:, rows], low, high, gain, loss)]
            if not len(rows):
                continue
            split = self.split[node]
            if isinstance(split, int):
                yield split, rows
                continue
            bit, below, above = split
            level, letter = divmod(bit, DIMS)
            stack += [(below, rows, low, high & ~_bits_of(letter, range(level, MOST))), (above, rows, low | _bits_of(letter, range(level + 1)), high)]


def near_pairs(queries: np.ndarray, words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query rows, word rows) one edit apart, by a k-d tree over ``words`` with tight boxes.  Both are
    Latin-1 matrices; words are as long as the queries or one letter longer."""
    gain, loss = (1, 1) if words.shape[1] == queries.shape[1] else (1, 0)
    q, w = vectors(queries), vectors(words)
    flags = _flags(w)
    stack = [(np.arange(len(words)), np.arange(len(queries)))]
    while stack:
        inside, asked = stack.pop()
        points = w[:, inside]
        asked = asked[_reach(q[:, asked], np.bitwise_and.reduce(points, axis=1), np.bitwise_or.reduce(points, axis=1), gain, loss)]
        if not len(asked):
            continue
        split = _best_split(flags[inside]) if len(inside) > LEAF else None
        if split is not None:
            above = flags[inside, split] == 1
            stack += [(inside[~above], asked), (inside[above], asked)]
            continue
        block = max(1, COMPARE // (8 * min(len(inside), 4096)))  # equal vectors can be many: words go in blocks too
        for i in range(0, len(asked), block):
            for j in range(0, len(inside), 4096):
                some, there = asked[i:i + block], inside[j:j + 4096]
                a, b = np.nonzero(_reach(q[:, some, None], w[:, None, there], w[:, None, there], gain, loss))
                yield from _verified(queries, words, some[a], there[b])


def _verified(queries: np.ndarray, words: np.ndarray, a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs whose letters, in order, are one edit apart."""
    length, more = queries.shape[1], words.shape[1] - queries.shape[1]
    step = max(1, COMPARE // length)
    for at in range(0, len(a), step):
        x, y = a[at:at + step], b[at:at + step]
        head = queries[x] == words[y][:, :length]
        if more:
            tail = queries[x] == words[y][:, 1:]
            first = np.where(head.all(axis=1), length, head.argmin(axis=1))
            last = np.where(tail.all(axis=1), length, tail[:, ::-1].argmin(axis=1))
            good = first + last >= length
        else:
            good = (~head).sum(axis=1) == 1
        if good.any():
            yield x[good], y[good]


def _codes(words: list[bytes]) -> np.ndarray:
    """Letters of words of one length as a matrix."""
    return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)


def _by_length(words: list[bytes]) -> dict[int, np.ndarray]:
    length = np.fromiter(map(len, words), np.int64, len(words))
    return {int(n): np.flatnonzero(length == n) for n in np.unique(length)}


# ------------------------------------------------------------------ search
def _dealing_cells(words: DataFrame, sample: int, cell: int) -> dict[int, Cells]:
    """Cells by word length, of the words that a hash takes, ``sample`` of them expected."""
    total = words.count()
    taken = F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < min(1.0, sample / max(total, 1)) * (1 << 30)
    some = [r[0].encode("latin-1") for r in words.filter(taken).select("word").collect()]
    per_cell = cell * len(some) / max(total, 1)
    return {n: Cells.of(vectors(_codes([some[i] for i in rows])), per_cell) for n, rows in _by_length(some).items()}


def _deal(words: DataFrame, cells: dict[int, Cells]) -> DataFrame:
    """(cell, asks, word, n): each word in its cell and as a query in those its searches reach."""
    shared = words.sparkSession.sparkContext.broadcast(cells)  # of the sample, not of the data
    whole = Cells([0], 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, counts = batch.column(0).to_pylist(), batch.column(1).to_numpy(zero_copy_only=False)
            words = [w.encode("latin-1") for w in names]
            for length, rows in _by_length(words).items():
                points = vectors(_codes([words[i] for i in rows]))
                for longer, gain, loss, asks in ((0, 0, 0, False), (0, 1, 1, True), (1, 1, 0, True)):
                    for leaf, some in shared.value.get(length + longer, whole).deal(points, gain, loss):
                        n, at = len(some), rows[some]
                        columns = [pa.array([f"{length + longer}/{leaf}"] * n, pa.string()), pa.array([asks] * n),
                                   pa.array([names[i] for i in at.tolist()], pa.string()), pa.array(counts[at])]
                        yield pa.RecordBatch.from_arrays(columns, ["cell", "asks", "word", "n"])

    return words.select("word", "n").mapInArrow(run, "cell string, asks boolean, word string, n long")


def _blocks(dealt: DataFrame, cell: int) -> DataFrame:
    """``dealt`` with (mine, theirs): the block of words and the block of queries a row goes to."""
    parts = lambda asks: F.greatest(F.ceil(F.count_if(F.col("asks") == asks) / cell).cast("int"), F.lit(1))
    sizes = dealt.groupBy("cell").agg(parts(False).alias("n_words"), parts(True).alias("n_queries"))
    sizes = sizes.filter("n_words > 1 or n_queries > 1")
    each = dealt.join(sizes, "cell", "left").fillna(1, ["n_words", "n_queries"])
    own = lambda n: F.pmod(F.xxhash64("word"), F.col(n)).cast("int")
    all_of = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    spots = F.when(F.col("asks"), F.transform(all_of("n_words"), lambda i: F.struct(i.alias("mine"), own("n_queries").alias("theirs")))).otherwise(
        F.transform(all_of("n_queries"), lambda j: F.struct(own("n_words").alias("mine"), j.alias("theirs"))))
    return each.select("cell", "asks", "word", "n", F.explode(spots).alias("s")).select("cell", "s.mine", "s.theirs", "asks", "word", "n")


def _search(group: pa.Table) -> pa.Table:
    """(word, other, other_n) of the near pairs between a block's words and its queries."""
    length = int(group.column("cell")[0].as_py().split("/")[0])
    asks, n = group.column("asks").to_numpy(), group.column("n").to_numpy()
    name = group.column("word").to_pylist()
    letters = [w.encode("latin-1") for w in name]
    left, right = [], []  # rows of a word and of one near it
    inside = np.flatnonzero(~asks)
    if len(inside):
        words = _codes([letters[i] for i in inside])
        size = np.fromiter(map(len, letters), np.int64, len(letters))
        for shorter in (0, 1):
            asked = np.flatnonzero(asks & (size == length - shorter))
            if len(asked):
                for x, y in near_pairs(_codes([letters[i] for i in asked]), words):
                    left.append(asked[x])
                    right.append(inside[y])
                    if shorter:  # the longer word asks no shorter ones
                        left.append(inside[y])
                        right.append(asked[x])
    a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right))
    spelt = lambda rows: pa.array([name[i] for i in rows.tolist()], pa.string())
    return pa.table({"word": spelt(a), "other": spelt(b), "other_n": pa.array(n[b], pa.int64())})


def near_words(words: DataFrame, sample: int = SAMPLE, cell: int = CELL) -> DataFrame:
    """(word, other, other_n): all ordered pairs of distinct ``words`` (word, n) one edit apart."""
    ship(words.sparkSession)
    dealt = cut(_deal(words, _dealing_cells(words, sample, cell)))
    blocks = _blocks(dealt, cell)
    return blocks.groupBy("cell", "mine", "theirs").applyInArrow(_search, "word string, other string, other_n long")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for ``forms`` (word, form): each step doubles how far a word has followed, and a word's
    frequency grows by ``RATIO`` a form, so steps are few."""
    roots = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("next"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        step = roots.withColumn("salt", F.pmod(F.xxhash64("word"), F.lit(SALTS)).cast("int")).join(onward, ["root", "salt"], "left")
        step = cut(step.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        roots = step.select("word", "root")
        if step.filter("moved").isEmpty():
            return roots


def group_variants(words: DataFrame, ratio: int = RATIO, sample: int = SAMPLE, cell: int = CELL) -> DataFrame:
    """Per word of ``words`` (word, n): ``form`` (its most frequent near word if at least ``ratio`` times
    as frequent), ``root`` (the last of its forms' forms), ``n``, ``n_near``, ``form_n``."""
    words = cut(words.select("word", "n"))
    pairs = near_words(words, sample, cell)
    best = pairs.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("m"), "other")).alias("b"))
    near = words.join(best, "word", "left")
    takes = -F.col("b.m") >= ratio * F.col("n")
    near = cut(near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                           F.when(takes, F.col("b.other")).alias("form"), F.when(takes, -F.col("b.m")).alias("form_n")))
    roots = _roots(near.filter("form is not null"))
    out = near.join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_variants(count_words(table(spark, sf_dir, "documents")))


#: crc32 (the reflected polynomial 0xEDB88320) over the bytes of id and run; all letters are below U+0100, so a
#: run's letter takes one byte or two.  Near words share a spelling with one letter taken out.
SQL = f"""
WITH runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
  FROM documents WHERE text IS NOT NULL),
counted AS (SELECT id, run, count(*) AS times FROM runs WHERE length(run) >= {MIN_LENGTH} GROUP BY ALL),
hashed AS (
  SELECT run, times, xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(id || ':' || run, ''),
         lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195::BIGINT, unicode(c)::BIGINT - 64] END))),
         lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)),
           lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))) AS h
  FROM counted),
words AS (
  SELECT word, CAST(sum(times) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % {ONE_IN} = 0 THEN left(run, CAST(h % length(run) AS BIGINT)) || substring(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word, times
    FROM hashed)
  WHERE length(word) >= {MIN_LENGTH} GROUP BY word HAVING sum(times) >= {MIN_COUNT}),
less AS (SELECT word, n, i, left(word, i - 1) || substring(word, i + 1) AS rest
         FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n FROM pairs GROUP BY word),
near AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= {RATIO} * n THEN other END AS form,
         CASE WHEN other_n >= {RATIO} * n THEN other_n END AS form_n
  FROM words LEFT JOIN best USING (word)),
chain AS (
  WITH RECURSIVE c AS (
    SELECT word, word AS latest, 0 AS steps FROM near
    UNION ALL SELECT c.word, near.form, steps + 1 FROM c JOIN near ON c.latest = near.word WHERE near.form IS NOT NULL)
  SELECT word, arg_max(latest, steps) AS root FROM c GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM near JOIN chain USING (word)
"""
