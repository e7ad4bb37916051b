"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

Each text becomes a row of document statistics (character classes, word and line
repetition, lengths).  Random cosine features of the standardised statistics
approximate a Gaussian kernel; every partition adds up its part of the normal
equations, the parts are summed by a grouped shuffle, and the small system
(``features`` + 1 unknowns, whatever the corpus) is solved on the driver.  A fold of
the labelled rows that the regression has not seen gives the isotonic calibration:
counts per score bin, at most ``BINS`` rows, pooled to a rising curve.

Defined results: null text counts as empty; empty texts have all statistics zero and
get a score like any other; label rows with a null id or quality are ignored; several
labels of one id count by their mean, 1 from one half up; without a labelled row
every score is 0.5; repeated rows get equal scores; extra columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm._common import crc_mod, cut, pick, ship, table

FEATURES, BANDWIDTH, RIDGE, SEED = 192, 4.0, 1e-4, 7
BINS, CALIBRATION_FOLDS = 2048, 5
#: Sums cross the shuffle as integers of this unit: their order changes nothing.
UNIT = 2.0 ** 20

STATISTICS = ("log_chars", "log_words", "log_lines", "mean_word", "long_words", "upper", "digits", "space", "points", "symbols",
              "bars", "exclaims", "odd", "distinct_words", "top_word", "next_same", "repeated_lines", "top_line", "no_letter_words",
              "capital_words", "odd_words")
_CLASSES = None


def _classes() -> np.ndarray:
    """Class of each code point: 0 other, 1 lower and uncased letters, 2 upper, 3 digit,
    4 space, 5 point, 6 symbol, 7 bar, 8 exclamation mark."""
    global _CLASSES
    if _CLASSES is None:
        import unicodedata

        by = {"Lu": 2, "Lt": 2, "Ll": 1, "Lo": 1, "Lm": 1, "Nd": 3, "Nl": 3, "No": 3, "Zs": 4, "Zl": 4, "Zp": 4,
              "Sc": 6, "Sk": 6, "Sm": 6, "So": 6, "Pc": 5, "Pd": 5, "Pe": 5, "Pf": 5, "Pi": 5, "Po": 5, "Ps": 5}
        t = np.array([by.get(unicodedata.category(chr(i)), 0) for i in range(0x110000)], np.uint8)
        for c, k in ((" \t\n\r\x0b\x0c", 4), ("#%&*@~^_\\/", 6), ("|", 7), ("!", 8)):
            t[[ord(x) for x in c]] = k
        _CLASSES = t
    return _CLASSES


def statistics(text: str) -> list[float]:
    """The document statistics, all of the whole text."""
    if not text:
        return [0.0] * len(STATISTICS)
    kinds = _classes()[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
    n = np.bincount(kinds, minlength=9) / len(text)
    letters = max(n[1] + n[2], 1e-9)
    words = text.split()
    k = max(len(words), 1)
    count = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    m = max(len(lines), 1)
    line_count = Counter(lines)
    plain = [w for w in count if w.isalpha()]
    return [np.log1p(len(text)), np.log1p(len(words)), np.log1p(len(lines)), sum(map(len, words)) / k,
            sum(c for w, c in count.items() if len(w) > 16) / k, n[2] / letters, n[3], n[4], n[5], n[6], n[7], n[8], n[0],
            len(count) / k ** 0.8, max(count.values(), default=0) / k, sum(map(eq, words, words[1:])) / k,
            1 - len(line_count) / m, max(line_count.values(), default=0) / m,
            sum(c for w, c in count.items() if not any(map(str.isalpha, w))) / k,
            sum(c for w, c in count.items() if w.isupper() and len(w) > 1) / k,
            1 - sum(count[w] for w in plain) / k]


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, x array<double>): one row per row of ``docs``."""
    ship(docs.sparkSession)
    schema = f"{id_col} {docs.schema[id_col].dataType.simpleString()}, x array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [[float(v) for v in statistics(t.as_py() or "")] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], [id_col, "x"])

    return pick(docs, id_col, text_col).mapInArrow(run, schema)


class Model:
    """Everything needed to score; its size is fixed by ``FEATURES`` and ``BINS``."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, features: int = FEATURES, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = mean, scale
        self.w = rng.normal(size=(len(mean), features)) / BANDWIDTH
        self.b = rng.uniform(0, 2 * np.pi, features)
        self.beta = np.zeros(features + 1)
        self.curve = (np.array([0.0]), np.array([0.5]))

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.hstack([np.cos(z @ self.w + self.b) * np.sqrt(2 / len(self.b)), np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.beta

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), *self.curve)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS)) if len(column) else np.zeros((0, len(STATISTICS)))


def pool(at: np.ndarray, ones: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression of ones / n over rising ``at``: (centres, rising values)."""
    blocks: list[list[float]] = []
    for a, y, w in zip(at.tolist(), ones.tolist(), n.tolist()):
        blocks.append([a * w, y, w])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last)]
    return np.array([s / w for s, _, w in blocks]), np.array([y / w for _, y, w in blocks])


def fit(labelled: DataFrame, id_col: str = "doc_id") -> Model:
    """``labelled`` (id, x, y): fit on all but one fold, calibrate on that fold."""
    spark = labelled.sparkSession
    sums = labelled.agg(*[f(F.col("x")[i]).alias(f"{n}{i}") for i in range(len(STATISTICS))
                          for n, f in (("m", F.avg), ("s", F.stddev_pop))], F.count("*").alias("n")).first()
    if not sums["n"]:
        return Model(np.zeros(len(STATISTICS)), np.ones(len(STATISTICS)))
    mean = np.array([sums[f"m{i}"] for i in range(len(STATISTICS))])
    scale = np.array([sums[f"s{i}"] for i in range(len(STATISTICS))])
    model = Model(mean, np.where(scale > 1e-9, scale, 1.0))
    d = FEATURES + 1
    fold = F.pmod(F.xxhash64(id_col), F.lit(CALIBRATION_FOLDS))
    shared = spark.sparkContext.broadcast(model)

    def normal_equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, seen = np.zeros((d, d + 1)), False
        for batch in batches:
            if batch.num_rows:
                phi, y = shared.value.features(_matrix(batch.column(0))), batch.column(1).to_numpy(zero_copy_only=False)
                a[:, :d] += phi.T @ phi
                a[:, d] += phi.T @ y
                seen = True
        if seen:
            i, j = np.nonzero(np.triu(np.ones((d, d + 1)), 0))
            yield pa.RecordBatch.from_arrays([pa.array(i * (d + 1) + j), pa.array(np.rint(a[i, j] * UNIT).astype(np.int64))], ["cell", "v"])

    cells = (labelled.filter(fold != 0).select("x", F.col("y").cast("double")).mapInArrow(normal_equations, "cell long, v long")
             .groupBy("cell").agg(F.sum("v").alias("v")).toPandas())
    if not len(cells):  # every labelled row fell into the calibration fold
        model.curve = (np.array([0.0]), np.array([float(labelled.agg(F.avg("y")).first()[0])]))
        return model
    a = np.zeros((d, d + 1))
    a.flat[cells["cell"].to_numpy()] = cells["v"].to_numpy() / UNIT
    gram = np.triu(a[:, :d]) + np.triu(a[:, :d], 1).T
    n = gram[-1, -1]
    penalty = np.eye(d) * RIDGE * n
    penalty[-1, -1] = 1e-9 * n
    model.beta = np.linalg.solve(gram + penalty, a[:, d])

    shared = spark.sparkContext.broadcast(model)

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            r = np.clip(shared.value.raw(_matrix(batch.column(0))), -0.5, 1.5)
            yield pa.RecordBatch.from_arrays([pa.array(np.rint((r + 0.5) / 2 * BINS).astype(np.int64)), batch.column(1)], ["bin", "y"])

    bins = (labelled.filter(fold == 0).select("x", F.col("y").cast("long")).mapInArrow(binned, "bin long, y long")
            .groupBy("bin").agg(F.count("*").alias("n"), F.sum("y").alias("ones")).toPandas().sort_values("bin"))
    if len(bins):
        base = bins["ones"].sum() / bins["n"].sum()  # a little of the base rate keeps pure bins off 0 and 1
        model.curve = pool(bins["bin"].to_numpy() / BINS * 2 - 0.5, bins["ones"].to_numpy() + 0.1 * base, bins["n"].to_numpy() + 0.1)
    else:
        model.curve = (np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    return model


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, held_out, score, predicted."""
    stats = cut(document_statistics(docs, id_col, text_col))
    marked = (pick(labels, "doc_id", "quality").filter("doc_id is not null and quality is not null")
              .groupBy("doc_id").agg(F.avg("quality").alias("q")).select(F.col("doc_id").alias("_id"), (F.col("q") >= 0.5).cast("int").alias("y")))
    training = stats.filter(crc_mod(F.col(id_col), 3) != 1).join(marked, F.col(id_col) == F.col("_id")).select(id_col, "x", "y")
    shared = docs.sparkSession.sparkContext.broadcast(fit(training, id_col))
    schema = f"{id_col} {docs.schema[id_col].dataType.simpleString()}, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = shared.value.score(_matrix(batch.column(1))) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.clip(score, 0, 1))], [id_col, "score"])

    scored = stats.mapInArrow(run, schema)
    return scored.select(id_col, (crc_mod(F.col(id_col), 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` predicted good, with all their columns.  Rows are scored in
    place: the model goes to the rows, so nothing is joined back by id."""
    spark = docs.sparkSession
    ship(spark)
    marked = (pick(labels, "doc_id", "quality").filter("doc_id is not null and quality is not null")
              .groupBy("doc_id").agg(F.avg("quality").alias("q")).select(F.col("doc_id").alias("_id"), (F.col("q") >= 0.5).cast("int").alias("y")))
    teachers = pick(docs, "doc_id", "text").filter(crc_mod(F.col("doc_id"), 3) != 1)
    training = cut(document_statistics(teachers).join(marked, F.col("doc_id") == F.col("_id")).select("doc_id", "x", "y"))
    shared = spark.sparkContext.broadcast(fit(training))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([statistics(t.as_py() or "") for t in batch.column("text")]).reshape(-1, len(STATISTICS))
            yield batch.filter(pa.array(shared.value.score(x) >= 0.5))

    return docs.mapInArrow(run, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
