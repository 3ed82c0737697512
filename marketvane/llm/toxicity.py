"""Toxicity as a severity grade, by cumulative-link ordinal regression.

The model has one weight a word, shared by all grades, and a rising threshold between each two grades:
P(grade <= k) = logistic(threshold_k - sum of the weights of the text's words). Its output is the expected grade.

It is fitted on a bounded sample of labelled documents (SAMPLE rows, the least hashes of their ids). The labels say
toxic or not; the grades of the toxic ones come from how many different words they have that set toxic documents
apart: 1, 2 or 3 (GRADES). Only words whose counts in the sample tell the classes apart get a weight.

Defined cases: a null text is an empty one, without words: it gets the expected grade of no evidence. A label whose
document is missing, or that is null, teaches nothing; without any toxic label all documents get severity 0. Words
are runs of ASCII letters, lower-cased, and of bytes above ASCII. Rows are scored one by one, repeated or not; several
labels of one id each teach. An empty table gets no scores. A text of any length is read whole, by one task. Other
columns are not read, so their names don't matter.

The given labels say toxic or not. Grades of the toxic are derived: the number of telling words they hold, cut at
GRADES. The regression then learns to weigh those words so that these grades come out; where graded labels exist they
should take this place.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_binary, map_slices
from .rolling import span_hashes

SAMPLE = 20_000
#: Of a toxic document's telling words: from 3 on grade 2, from 6 on grade 3.
GRADES = (3, 6)
#: Likelihood ratio from which a word gets a weight, and the toxic documents that must have it.
TELLING, LEAST_DOCS = 12.0, 3
STEPS, RATE, RIDGE = 300, 0.1, 1e-3

_LETTER = np.zeros(256, np.uint8)
_LETTER[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LETTER[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LETTER[0x80:] = np.arange(0x80, 0x100)


def words(text: bytes) -> np.ndarray:
    """The sorted distinct hashes of a text's words."""
    codes = _LETTER[np.frombuffer(text, np.uint8)]
    edge = np.diff(np.concatenate(([True], codes == 0, [True])).astype(np.int8))
    return np.unique(span_hashes(codes, np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)))


@dataclass(frozen=True)
class Model:
    features: np.ndarray  #: hashes, sorted
    weights: np.ndarray
    thresholds: np.ndarray

    def evidence(self, own: np.ndarray) -> float:
        at = np.searchsorted(self.features, own)
        hit = at < len(self.features)
        hit[hit] = self.features[at[hit]] == own[hit]
        return float(self.weights[at[hit]].sum())

    def grades(self, evidence: np.ndarray) -> np.ndarray:
        """The probability of each grade, a row for each value."""
        upto = 1 / (1 + np.exp(-np.clip(self.thresholds - evidence[:, None], -40, 40)))
        return np.diff(np.concatenate([np.zeros((len(evidence), 1)), upto, np.ones((len(evidence), 1))], axis=1), axis=1)


def fit(texts: list[np.ndarray], toxic: np.ndarray) -> Model:
    """The model of word sets and labels."""
    none = Model(np.zeros(0, np.uint64), np.zeros(0), np.array([40.0, 41.0, 42.0]))
    if not toxic.any():
        return none
    row = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    features, column = np.unique(np.concatenate(texts), return_inverse=True)
    in_toxic = np.bincount(column, toxic[row], len(features))
    in_clean = np.bincount(column, minlength=len(features)) - in_toxic
    n_toxic, n_clean = toxic.sum(), len(toxic) - toxic.sum()
    rate = (in_toxic + in_clean + 1) / (len(toxic) + 2)
    p, q = (in_toxic + 0.5) / (n_toxic + 1), (in_clean + 0.5) / (n_clean + 1)
    ratio = 2 * (
        in_toxic * np.log(p / rate) + (n_toxic - in_toxic) * np.log((1 - p) / (1 - rate))
        + in_clean * np.log(q / rate) + (n_clean - in_clean) * np.log((1 - q) / (1 - rate))
    )
    telling = (ratio >= TELLING) & (p > q) & (in_toxic >= LEAST_DOCS)
    if not telling.any():
        return none
    number = np.cumsum(telling) - 1
    row, column = row[telling[column]], number[column[telling[column]]]
    grade = np.where(toxic, 1 + np.searchsorted(GRADES, np.bincount(row, minlength=len(texts)), "right"), 0)

    # P(grade = k) = F(t_k - x) - F(t_(k-1) - x); thresholds are a first one and positive steps. Adam, whole batch.
    k = len(GRADES) + 1
    value = np.concatenate([np.zeros(telling.sum()), [1.0], np.zeros(k - 1)])
    moment, square = np.zeros_like(value), np.zeros_like(value)
    n_words = int(telling.sum())
    for step in range(1, STEPS + 1):
        w, steps = value[:n_words], np.exp(value[n_words + 1 :])
        t = value[n_words] + np.concatenate([[0.0], np.cumsum(steps)])
        x = np.bincount(row, w[column], len(texts))
        bounds = np.concatenate([[-np.inf], t, [np.inf]])
        high, low = bounds[grade + 1] - x, bounds[grade] - x
        f_high, f_low = 1 / (1 + np.exp(-np.clip(high, -40, 40))), 1 / (1 + np.exp(-np.clip(low, -40, 40)))
        f_high[grade == k], f_low[grade == 0] = 1.0, 0.0
        mass = np.maximum(f_high - f_low, 1e-12)
        d_high, d_low = f_high * (1 - f_high) / mass, f_low * (1 - f_low) / mass
        g_x = (d_high - d_low) / len(texts)
        g_t = np.zeros(k + 2)
        np.add.at(g_t, grade + 1, -d_high / len(texts))
        np.add.at(g_t, grade, d_low / len(texts))
        g_t = g_t[1:-1]
        g_steps = np.cumsum(g_t[::-1])[::-1][1:] * steps
        slope = np.concatenate([np.bincount(column, g_x[row], n_words) + RIDGE * w / n_words, [g_t.sum()], g_steps])
        moment = 0.9 * moment + 0.1 * slope
        square = 0.999 * square + 0.001 * slope**2
        value = value - RATE * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-10)
    thresholds = value[n_words] + np.concatenate([[0.0], np.cumsum(np.exp(value[n_words + 1 :]))])
    return Model(features[telling], value[:n_words], thresholds)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Fits on at most SAMPLE labelled documents, in one task; what comes back is the model."""
    chosen = (
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .select(F.col(id_col).alias("label_id"), F.col(label_col).cast("boolean").alias("toxic"))
        .orderBy(F.xxhash64("label_id"), "label_id", "toxic")
        .limit(SAMPLE)
    )
    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = given.join(F.broadcast(chosen), F.col("id") == F.col("label_id"))

    def hashed(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [words(t or b"").tobytes() for t in as_binary(batch.column("text")).to_pylist()]
        return pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), batch.column("toxic")], ["words", "toxic"])

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, toxic = [], []
        for batch in batches:
            texts += [np.frombuffer(w, np.uint64) for w in batch.column("words").to_pylist()]
            toxic += batch.column("toxic").to_pylist()
        order = sorted(range(len(texts)), key=lambda k: (texts[k].tobytes(), toxic[k]))  # sums in one order: reruns agree
        model = fit([texts[k] for k in order], np.array(toxic, bool)[order] if order else np.zeros(0, bool))
        parts = [pa.array([x.tobytes()], pa.binary()) for x in (model.features, model.weights, model.thresholds)]
        yield pa.RecordBatch.from_arrays(parts, ["features", "weights", "thresholds"])

    sets = map_slices(rows.select("text", "toxic"), hashed, "words binary, toxic boolean", "text")
    model = sets.repartition(1).mapInArrow(fitted, "features binary, weights binary, thresholds binary").first()
    if model is None:
        return fit([], np.zeros(0, bool))
    kinds = (np.uint64, np.float64, np.float64)
    return Model(*(np.frombuffer(bytes(x), kind) for x, kind in zip(model, kinds, strict=True)))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: id, `severity` (the expected grade), `p_toxic` and `toxic` (more likely than not)."""

    def scored(batch: pa.RecordBatch) -> pa.RecordBatch:
        evidence = np.array([model.evidence(words(t or b"")) for t in as_binary(batch.column("text")).to_pylist()], float)
        odds = model.grades(evidence)
        severity = np.round(odds @ np.arange(odds.shape[1]), 9)
        return pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(severity), pa.array(np.round(1 - odds[:, 0], 9)), pa.array(odds[:, 0] < 0.5)],
            ["id", "severity", "p_toxic", "toxic"],
        )

    frame = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = frame.schema["id"].dataType.simpleString()
    return map_slices(frame, scored, f"id {kind}, severity double, p_toxic double, toxic boolean", "text").withColumnRenamed("id", id_col)
