"""Quality classifier: cumulative-link (ordinal) regression on graded ratings over hashed text."""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import MEMO_ENTRIES, batches, kept_in_worker, table, texts

BITS = 18
PUNCTUATION = bytes(range(33, 48)) + bytes(range(58, 65)) + bytes(range(91, 97)) + bytes(range(123, 127))
SYMBOL, UPPER, LOUD = 1 << BITS, 2 << BITS, 4 << BITS  # flags beside a word's index
DENSE = 7
ROWS_PER_GRADE = 3000  # bound of the sample that is fitted, by grade
BEGINNINGS = (2, 3, 4, 5)  # lengths of word beginnings that are features, too
LEAST_SIGNAL = 4.0  # standard deviations by which a feature's count in some grade leaves chance, to get a weight
KEEP_TAIL = 0.05  # least probability of the best grade
MOST_WORST = 0.5  # most probability of the worst grade


class WordFeatures(dict):
    """A word's hashed indices (itself and its beginnings), the first with its flags, as bytes."""

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= MEMO_ENTRIES:
            self.clear()
        core = word.strip(PUNCTUATION)
        core = core.lower() if core.isascii() else core.decode(errors="replace").lower().encode()
        own = [xxhash.xxh3_64_intdigest(x) & ((1 << BITS) - 1) for x in (core, *(b"^" + core[:n] for n in BEGINNINGS))]
        own[0] |= SYMBOL * any(c in word for c in b"#*$%&|<>") | UPPER * (len(core) > 1 and word.isupper()) | LOUD * word.endswith(b"!!")
        self[word] = found = array("i", own).tobytes()
        return found


def featurised(text: bytes, memo: WordFeatures) -> tuple[np.ndarray, list[float]]:
    """Indices of the distinct words and beginnings; shares of flagged, repeated and all words."""
    words = text.split()
    if not words:
        return np.empty(0, np.int64), [0.0] * DENSE
    all_ = np.frombuffer(b"".join(map(memo.__getitem__, words)), np.int32).reshape(len(words), -1)
    first = all_[:, 0]
    shares = [np.count_nonzero(first & f) / len(words) for f in (SYMBOL, UPPER, LOUD)]
    distinct = len(np.unique(first)) / len(words)
    again = np.count_nonzero(first[1:] == first[:-1]) / len(words)
    own = np.unique(all_ & ((1 << BITS) - 1)).astype(np.int64)
    return own, [*shares, distinct, again, np.log1p(len(words)) / 10, float(len(words) < 5)]


@dataclass(frozen=True)
class OrdinalModel:
    """P(grade <= k) = sigmoid(thresholds[k] - score): one weight vector, ordered thresholds."""

    words: np.ndarray
    dense: np.ndarray
    thresholds: np.ndarray

    def score(self, own: np.ndarray, dense: list[float]) -> float:
        return float(self.words[own].sum() + self.dense @ dense)

    def at_most(self, scores: np.ndarray) -> np.ndarray:
        """A column for each threshold."""
        return 1 / (1 + np.exp(-np.clip(self.thresholds[None, :] - scores[:, None], -40, 40)))


def fit(lists: list[np.ndarray], dense: np.ndarray, grades: np.ndarray, n_grades: int, steps: int = 250, rate: float = 0.05, penalty: float = 2e-4) -> OrdinalModel:
    """Maximum likelihood with an L2 penalty by Adam on all rows; grades weigh alike."""
    row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    index = np.concatenate(lists) if lists else np.empty(0, np.int64)
    size = np.bincount(grades, minlength=n_grades)
    found = np.stack([np.bincount(index[grades[row] == g], minlength=1 << BITS) for g in range(n_grades)])
    expected = found.sum(axis=0)[None, :] * (size / max(1, len(grades)))[:, None]
    known = (np.abs(found - expected) >= LEAST_SIGNAL * np.sqrt(expected + 1)).any(axis=0)
    row, index = row[known[index]], index[known[index]]
    w, v, first, gaps = np.zeros(1 << BITS), np.zeros(DENSE), np.array([-0.5]), np.zeros(n_grades - 2)
    weight = (1 / np.maximum(size, 1))[grades] / max(1, np.count_nonzero(size))
    parts = [w, v, first, gaps]
    mean, square = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    for t in range(1, steps + 1):
        cuts = np.concatenate([first, first + np.cumsum(np.exp(gaps))])
        s = np.bincount(row, w[index], len(lists)) + dense @ v
        high = 1 / (1 + np.exp(-np.clip(np.append(cuts, 40.0)[grades] - s, -40, 40)))
        low = np.where(grades > 0, 1 / (1 + np.exp(-np.clip(np.append(-40.0, cuts)[grades] - s, -40, 40))), 0.0)
        high = np.where(grades == n_grades - 1, 1.0, high)
        p = np.maximum(high - low, 1e-9)
        ds = weight * (high + low - 1)  # of the log likelihood by the score
        by_cut = np.bincount(grades, weight * high * (1 - high) / p, n_grades)[:-1] - np.bincount(grades, weight * low * (1 - low) / p, n_grades)[1:]
        later = np.cumsum(by_cut[::-1])[::-1]
        grad = [np.bincount(index, ds[row], 1 << BITS) - penalty * w, ds @ dense - penalty * v, later[:1], later[1:] * np.exp(gaps)]
        for part, g, m, q in zip(parts, grad, mean, square, strict=True):
            m += 0.1 * (g - m)
            q += 0.001 * (g * g - q)
            part += rate * (m / (1 - 0.9**t)) / (np.sqrt(q / (1 - 0.999**t)) + 1e-6)
    return OrdinalModel(w.astype(np.float32), v, np.concatenate([first, first + np.cumsum(np.exp(gaps))]))


def fit_on_table(docs: DataFrame, ratings: DataFrame, n_grades: int = 3, rows_per_grade: int = ROWS_PER_GRADE) -> OrdinalModel | None:
    """Fit on at most rows_per_grade rated documents of each grade, the first by hashed id.

    ratings: (doc_id, grade from 0).  Several ratings of a document: the lowest counts; null
    ids and grades are left out.  None if no two grades are met.
    """
    rated = ratings.where("doc_id IS NOT NULL AND grade IS NOT NULL").groupBy("doc_id").agg(F.min("grade").alias("grade"))
    sample = None
    for g in range(n_grades):
        part = rated.where(F.col("grade") == g).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows_per_grade)
        sample = part if sample is None else sample.union(part)
    chosen = docs.select("doc_id", "text").join(F.broadcast(sample.withColumnRenamed("doc_id", "_id")), F.col("doc_id") == F.col("_id"))
    out = pa.schema([("doc_id", pa.int64()), ("grade", pa.int32()), ("own", pa.binary()), ("dense", pa.list_(pa.float64()))])

    def features(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = kept_in_worker("features", WordFeatures)

        def of(batch: pa.RecordBatch) -> list:
            found = [featurised(x, memo) for x in texts(batch)]
            return [batch.column("doc_id"), batch.column("grade"), [o.astype(np.int32).tobytes() for o, _ in found], [d for _, d in found]]

        return batches(rows, out, of)

    chosen = chosen.select("doc_id", F.col("grade").cast("int"), "text")
    got = sorted(chosen.mapInArrow(features, "doc_id long, grade int, own binary, dense array<double>").collect(), key=lambda r: (r.doc_id, bytes(r.own)))
    if len({r.grade for r in got}) < 2:
        return None
    return fit([np.frombuffer(bytes(r.own), np.int32).astype(np.int64) for r in got], np.array([r.dense for r in got]), np.array([r.grade for r in got]), n_grades)


def _judged(model: OrdinalModel | None, batch: pa.RecordBatch, keep_tail: float, most_worst: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if model is None:
        n = batch.num_rows
        return np.zeros(n), np.zeros((n, 2)), np.ones(n, bool)
    memo = kept_in_worker("features", WordFeatures)
    scores = np.array([model.score(*featurised(x, memo)) for x in texts(batch)])
    below = model.at_most(scores)
    return scores, below, (1 - below[:, -1] >= keep_tail) & (below[:, 0] <= most_worst)


def graded(docs: DataFrame, model: OrdinalModel | None, keep_tail: float = KEEP_TAIL, most_worst: float = MOST_WORST) -> DataFrame:
    """(doc_id, score, expected_grade, p_worst, p_best, kept) per row.

    kept: the best grade has at least keep_tail, the worst at most most_worst probability.
    A null or empty text is judged as a text without words.  Without a model (no ratings)
    all rows are kept.  Other columns aren't read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    out = pa.schema([("doc_id", pa.int64()), *[(n, pa.float64()) for n in ("score", "expected_grade", "p_worst", "p_best")], ("kept", pa.bool_())])

    def judge(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def of(batch: pa.RecordBatch) -> list:
            scores, below, kept = _judged(shared.value, batch, keep_tail, most_worst)
            return [batch.column("doc_id"), scores, (1 - below).sum(axis=1), below[:, 0], 1 - below[:, -1], kept]

        return batches(rows, out, of)

    return docs.select("doc_id", "text").mapInArrow(judge, "doc_id long, score double, expected_grade double, p_worst double, p_best double, kept boolean")


def select_kept(docs: DataFrame, model: OrdinalModel | None, keep_tail: float = KEEP_TAIL, most_worst: float = MOST_WORST) -> DataFrame:
    """The rows of docs, with all their columns, that graded() keeps."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def choose(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            yield batch.filter(pa.array(_judged(shared.value, batch, keep_tail, most_worst)[2]))

    return docs.mapInArrow(choose, docs.schema)


def grades_of_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, grade): 0 toxic, 1 poor, 2 good; null where a label is missing."""
    return labels.select("doc_id", F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 2).alias("grade"))


def op9_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return graded(docs, fit_on_table(docs, grades_of_labels(table(spark, sf_dir, "labels"))))
