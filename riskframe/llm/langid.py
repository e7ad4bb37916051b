"""Language identification of mixed-language text.

Words are maximal runs of letters.  A word's script (by Unicode range) leaves the
languages seen with that script in training; each of those gets the word's letter
trigram score, the others a floor.  Viterbi over a text's words with a penalty for
every switch labels its spans; the language of a text is the one with most letters in
its spans.

Training counts trigrams and scripts per language on a bounded sample: about
``SAMPLE`` texts a language, chosen by a hash of the id.  Counting runs on the
executors; the driver gets at most languages x ``BUCKETS`` counts.

Viterbi runs on blocks of ``BLOCK`` words for all texts of a batch at once: for each
block the best score from every entering to every leaving language, then the chain
of blocks, then the words inside the blocks.  A text of any length is labelled as a
whole, in bounded memory beside the text.

Defined results: null text, or one without a letter, gives ``und`` with score 0; ties
go to the first language in sorted order; without any labelled row everything is
``und``; repeated rows get equal results; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm._common import crc_mod, pick, ship, table

SAMPLE, BUCKETS = 1500, 1 << 16
SWITCH, FLOOR, SMOOTH = 12.0, -30.0, 0.5
BLOCK = 128
#: Code points scored at once.
CHUNK = 1 << 20
#: First code points of the script ranges; letters between two of them share a class.
SCRIPTS = (0x0041, 0x0370, 0x0400, 0x0530, 0x0590, 0x0600, 0x0700, 0x0900, 0x0E00, 0x1000, 0x10A0, 0x1100, 0x1200, 0x1E00, 0x1F00,
           0x2000, 0x3040, 0x30A0, 0x3100, 0x4E00, 0xAC00, 0xD7B0)

_letters = None


def _letter_tables() -> tuple[np.ndarray, np.ndarray]:
    """For each code point: itself in lower case if it is a letter, else 0; its script."""
    global _letters
    if _letters is None:
        lower = np.zeros(0x110000, np.uint32)
        for i in range(0x110000):
            c = chr(i)
            if c.isalpha():
                low = c.lower()
                lower[i] = ord(low) if len(low) == 1 else i
        script = np.searchsorted(SCRIPTS, np.arange(0x110000), side="right").astype(np.uint8)
        script[(script == 14) | (script == 1)] = 1  # Latin and its extensions
        _letters = lower, script
    return _letters


def _trigrams(c: np.ndarray) -> np.ndarray:
    """Bucket of the trigram around each position; non-letters are word ends."""
    before, after = np.append(np.uint32(0), c[:-1]), np.append(c[1:], np.uint32(0))
    x = before * np.uint32(0x9E3779B1) ^ (c * np.uint32(0x85EBCA77) + np.uint32(1)) ^ after * np.uint32(0xC2B2AE3D)
    return (x ^ (x >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(16)


def _points(text: str) -> tuple[np.ndarray, np.ndarray]:
    lower, script = _letter_tables()
    raw = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return lower[raw], script[raw]


class Model:
    """Log scores: ``trigram`` (BUCKETS, languages), ``script`` (classes, languages) bool."""

    def __init__(self, languages: list[str], counts: np.ndarray, scripts: np.ndarray):
        self.languages = languages
        total = counts.sum(axis=0, keepdims=True) + SMOOTH * BUCKETS
        self.trigram = np.log((counts + SMOOTH) / total).astype(np.float32)
        share = scripts / np.maximum(scripts.sum(axis=0, keepdims=True), 1)
        self.script = share > 1e-4

    def words(self, c: np.ndarray, script: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first, end, scores (words, languages)) of the words in ``c``."""
        inside = np.append(np.append(False, c != 0), False)
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        first, end = edge[::2], edge[1::2]
        if not len(first):
            return first, end, np.zeros((0, len(self.languages)), np.float32)
        at = np.flatnonzero(c)
        per_letter = self.trigram[_trigrams(c)[at]]
        begin = np.append(0, np.cumsum(end - first)[:-1])
        scores = np.add.reduceat(per_letter, begin, axis=0)
        allowed = self.script[script[first]]
        some = allowed.any(axis=1)
        scores += np.where(allowed | ~some[:, None], 0, FLOOR).astype(np.float32)
        return first, end, scores


def viterbi(scores: np.ndarray, text_of: np.ndarray, n_texts: int, switch: float = SWITCH, block: int = BLOCK) -> np.ndarray:
    """Best language of each word; words of a text are consecutive, ``text_of`` rises."""
    w, k = scores.shape
    if not w:
        return np.zeros(0, np.int64)
    n = np.bincount(text_of, minlength=n_texts)
    start = np.cumsum(n) - n
    n_blocks = -(-n // block)
    block_text = np.repeat(np.arange(n_texts), n_blocks)
    nth = np.arange(len(block_text)) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks)
    inside = np.arange(w) - start[text_of]
    place = (np.cumsum(n_blocks) - n_blocks)[text_of] + inside // block
    grid = np.zeros((len(block_text), block, k), np.float32)  # after a text's end: no score, no switch pays
    grid[place, inside % block] = scores
    best = np.where(np.eye(k, dtype=bool), 0, -np.inf)[None].repeat(len(block_text), 0)  # entering x leaving language
    for t in range(block):
        best = np.maximum(best, best.max(axis=2, keepdims=True) - switch) + grid[:, t, None, :]
    # chain the blocks: value[j] is the best score that leaves block j-1 of a text in each language
    value, came = np.zeros((n_texts, k)), np.zeros((len(block_text), k), np.int64)
    firsts = np.cumsum(n_blocks) - n_blocks
    for j in range(int(n_blocks.max())):
        here = np.flatnonzero(n_blocks > j)
        b = firsts[here] + j
        step = value[here][:, :, None] + best[b]
        came[b] = step.argmax(axis=1)
        value[here] = step.max(axis=1)
    leave, enter = np.zeros(len(block_text), np.int64), np.zeros(len(block_text), np.int64)
    state = value.argmax(axis=1)
    for j in range(int(n_blocks.max()) - 1, -1, -1):
        here = np.flatnonzero(n_blocks > j)
        b = firsts[here] + j
        leave[b] = state[here]
        state[here] = enter[b] = came[b, state[here]]
    # words inside the blocks, now that both ends are known
    v = np.where(np.arange(k)[None] == enter[:, None], 0, -np.inf)
    back = np.zeros((block, len(block_text), k), np.int8 if k < 128 else np.int32)
    own = np.arange(k)[None]
    for t in range(block):
        top = v.argmax(axis=1)
        jump = v.max(axis=1, keepdims=True) - switch
        stay = v >= jump
        back[t] = np.where(stay, own, top[:, None])
        v = np.where(stay, v, jump) + grid[:, t]
    path = np.zeros((len(block_text), block), np.int64)
    state, rows = leave, np.arange(len(block_text))
    for t in range(block - 1, -1, -1):
        path[:, t] = state
        state = back[t, rows, state].astype(np.int64)
    return path[place, inside % block]


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> Model | None:
    """Learn from every row of ``docs`` with a language that the hash sample takes:
    ``sample`` texts a language expected."""
    spark = docs.sparkSession
    ship(spark)
    rows = pick(docs, id_col, text_col, lang_col).filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    have = {r[0]: r[1] for r in rows.groupBy(lang_col).count().collect()}  # one row a language
    languages = sorted(have)
    if not languages:
        return None
    share = F.create_map(*[x for g in languages for x in (F.lit(g), F.lit(min(1.0, sample / have[g])))])
    chance = F.pmod(F.xxhash64(id_col, F.lit("language sample")), F.lit(1 << 30)) / float(1 << 30)
    chosen = rows.filter(chance < share[F.col(lang_col)]).select(lang_col, text_col)
    number = {g: i for i, g in enumerate(languages)}
    n_scripts = len(SCRIPTS) + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, np.ndarray] = {}
        for b in batches:
            for g, text in zip(b.column(0).to_pylist(), b.column(1)):
                c, script = _points(text.as_py())
                at = c != 0
                mine = seen.setdefault(number[g], np.zeros(BUCKETS + n_scripts, np.int64))
                mine[:BUCKETS] += np.bincount(_trigrams(c)[at], minlength=BUCKETS)
                mine[BUCKETS:] += np.bincount(script[at], minlength=n_scripts)
        for g, mine in seen.items():
            cell = np.flatnonzero(mine)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(cell), g)), pa.array(cell), pa.array(mine[cell])], ["lang", "cell", "n"])

    cells = chosen.mapInArrow(count, "lang long, cell long, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((BUCKETS + n_scripts, len(languages)))
    counts[cells["cell"].to_numpy(np.int64), cells["lang"].to_numpy(np.int64)] = cells["n"].to_numpy()
    return Model(languages, counts[:BUCKETS], counts[BUCKETS:])


def label_spans(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, lang_pred, score (share of the text's letters in
    spans of that language), spans (first code point, end, language)."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    schema = (f"{id_col} {docs.schema[id_col].dataType.simpleString()}, lang_pred string, score double, "
              "spans array<struct<first:int,end:int,lang:string>>")
    span_type = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))

    def of_texts(m: Model, texts: list[str]) -> tuple[list, list, list]:
        text = "\n".join(texts)
        c, script = _points(text)
        first, end, scores = m.words(c, script)
        edges = np.cumsum([0] + [len(t) + 1 for t in texts])
        text_of = np.searchsorted(edges, first, side="right") - 1
        path = viterbi(scores, text_of, len(texts))
        k = len(m.languages)
        letters = np.bincount(text_of * k + path, weights=end - first, minlength=len(texts) * k).reshape(-1, k)
        total, top = letters.sum(axis=1), letters.argmax(axis=1)
        langs = [m.languages[t] if n else "und" for t, n in zip(top.tolist(), total.tolist())]
        score = np.where(total > 0, letters[np.arange(len(texts)), top] / np.maximum(total, 1), 0.0)
        cut = np.flatnonzero(np.append(True, (path[1:] != path[:-1]) | (text_of[1:] != text_of[:-1]))) if len(path) else np.zeros(0, int)
        last = np.append(cut[1:], len(path)) - 1 if len(path) else cut
        spans: list[list[dict]] = [[] for _ in texts]
        for t, x, y, g in zip(text_of[cut].tolist(), first[cut].tolist(), end[last].tolist(), path[cut].tolist()):
            spans[t].append({"first": x - int(edges[t]), "end": y - int(edges[t]), "lang": m.languages[g]})
        return langs, score.tolist(), spans

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            langs, score, spans = [], [], []
            at = 0
            while at < len(texts):
                upto, size = at, 0
                while upto < len(texts) and (upto == at or size + len(texts[upto]) <= CHUNK):
                    size += len(texts[upto])
                    upto += 1
                part = of_texts(m, texts[at:upto]) if m else (["und"] * (upto - at), [0.0] * (upto - at), [[]] * (upto - at))
                langs, score, spans = langs + part[0], score + part[1], spans + part[2]
                at = upto
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(langs, pa.string()), pa.array(score, pa.float64()), pa.array(spans, span_type)],
                                             [id_col, "lang_pred", "score", "spans"])

    return pick(docs, id_col, text_col).mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = crc_mod(F.col("doc_id"), 4) == 2
    model = train(docs.filter(~held))
    return label_spans(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))
