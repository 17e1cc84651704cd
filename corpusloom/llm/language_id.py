"""Language identification with blended-spectrum string kernels.

A text is the set of its distinct 1- to 3-byte substrings (UTF-8, A-Z lower-cased).
The kernel of two texts counts the substrings both have, normalised to 1 for
equal sets.  Landmarks (a bounded, documented sample of labelled texts) span the
feature space (Nystrom); one-versus-rest kernel ridge regression is fitted on
the sums of normal equations over *all* labelled texts, and whole batches are
scored by matrix products.

Defined results: a null text and a text without a letter get ``und`` and score 0;
null labels teach nothing; with no labelled text at all every text is ``und``;
repeated rows get equal results, equal scores go to the first label of the alphabet, and
texts of any length count whole; more than ``most_labels`` labels are an error; given columns
named ``lang_pred`` or ``score`` are replaced, all others stay, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import LOWER_BYTES, encoded, plus, quoted, summed

UNDETERMINED = "und"
_TABLE = np.frombuffer(LOWER_BYTES, np.uint8).astype(np.uint32)
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True


def _grams(text: bytes) -> np.ndarray:
    """Codes of all 1-, 2- and 3-byte substrings, with repeats; the lengths share one code space below 2^24 + 2^16 + 2^8."""
    x = _TABLE[np.frombuffer(text, np.uint8)]
    two = (x[:-1] << 8) | x[1:]
    three = (two[:-1] << 8) | x[2:]
    return np.concatenate([x, two + np.uint32(256), three + np.uint32(256 + 65536)])


def has_letter(text: bytes) -> bool:
    x = np.frombuffer(text, np.uint8)
    return bool(_ASCII_LETTER[x].any()) or (bool((x > 127).any()) and any(c.isalpha() for c in text.decode("utf-8", "replace")))


@dataclass
class Model:
    """Everything that scoring needs; its size is bounded by the landmark sample."""

    labels: list[str]
    grams: np.ndarray  #: sorted codes of the landmarks' substrings
    landmarks: np.ndarray  #: substrings x landmarks, 1 / sqrt(size) where present
    whiten: np.ndarray  #: landmarks x rank
    weights: np.ndarray  #: (rank + 1) x labels

    def slots(self) -> np.ndarray:
        lut = np.full(256 + 65536 + (1 << 24), len(self.grams), np.int32)
        lut[self.grams] = np.arange(len(self.grams), dtype=np.int32)
        return lut

    def features(self, texts: list[bytes], lut: np.ndarray) -> np.ndarray:
        present = np.zeros((len(texts), len(self.grams) + 1), np.float32)
        for i, text in enumerate(texts):
            present[i, lut[_grams(text)]] = 1
        present = present[:, :-1]
        size = np.sqrt(np.maximum(present.sum(1, keepdims=True), 1))
        kernel = (present @ self.landmarks) / size
        return np.hstack([kernel @ self.whiten, np.ones((len(texts), 1), np.float32)]).astype(np.float64)


def landmark_model(texts: list[str], labels: list[str]) -> Model:
    sets = [np.unique(_grams(t.encode())) for t in texts]
    grams = np.unique(np.concatenate(sets)) if sets else np.zeros(0, np.uint32)
    matrix = np.zeros((len(grams), len(sets)), np.float32)
    for j, s in enumerate(sets):
        matrix[np.searchsorted(grams, s), j] = 1 / np.sqrt(max(1, len(s)))
    values, vectors = np.linalg.eigh((matrix.T @ matrix).astype(np.float64)) if sets else (np.zeros(0), np.zeros((0, 0)))
    good = values > 1e-6 * max(values.max(initial=0), 1e-12)
    whiten = (vectors[:, good] / np.sqrt(values[good])).astype(np.float32)
    return Model(labels, grams, matrix, whiten, np.zeros((whiten.shape[1] + 1, len(labels))))


def fit(train: DataFrame, text: str = "text", label: str = "lang", key: str = "doc_id", landmarks_per_label: int = 24, ridge: float = 1e-3, block: int = 128, landmark_bytes: int = 16 << 10, most_labels: int = 1000) -> Model:
    """A model from the rows of ``train``.

    The sample, bounded by ``landmarks_per_label`` times the number of labels, takes
    the texts of each label with the least hash of their id, among those of ``landmark_bytes``
    at most, as the driver holds them; every row enters the normal equations.
    """
    train = train.select(quoted(key).cast("string").alias("k"), quoted(text).alias("t"), quoted(label).alias("l")).where("t is not null and t <> '' and l is not null")
    labels = sorted(r.l for r in train.select("l").distinct().limit(most_labels + 1).collect())
    if len(labels) > most_labels:
        raise ValueError(f"more than {most_labels} labels")
    order = F.struct(F.xxhash64(F.lit(7), "k"), "k", "t")
    # Rows pre-aggregated by slots of the hash, so that no task gathers a label's texts.
    slot = F.pmod(F.xxhash64(F.lit(11), "k"), F.lit(landmarks_per_label))
    short = train.where(F.octet_length("t") <= landmark_bytes)
    model = landmark_model(sorted(r.o[2] for r in short.groupBy("l", slot.alias("s")).agg(F.min(order).alias("o")).collect()), labels)
    width, n = model.weights.shape

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lut, total = model.slots(), np.zeros((width, width + n))
        for batch in batches:
            texts, labels = encoded(batch.column(0)), batch.column(1).to_pylist()
            for at in range(0, len(texts), block):
                x = model.features(texts[at : at + block], lut)
                y = np.array([[float(v == c) for c in model.labels] for v in labels[at : at + block]])
                total += x.T @ np.hstack([x, y])
        yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], ["blob"])

    if labels:
        total = summed(train.select("t", "l").mapInArrow(partial, "blob binary"), "blob").reshape(width, width + n)
        penalty = ridge * max(1.0, total[-1, width - 1]) * np.eye(width)
        penalty[-1, -1] = 1e-9
        model.weights = np.linalg.solve(total[:, :width] + penalty, total[:, width:])
    return model


def predict(docs: DataFrame, model: Model, text: str = "text", block: int = 128, batch_columns: list[Column] | None = None) -> DataFrame:
    """The given columns (all, if none are named) with ``lang_pred`` and ``score``, in place of any such columns.

    ``score`` is the share of the predicted label in the labels' clipped ridge outputs.
    """
    columns = batch_columns or [quoted(c) for c in docs.columns if c not in ("lang_pred", "score")]
    kept, source = docs.select(*columns), docs.select(*columns, quoted(text).alias("__text"))
    schema = plus(kept, "lang_pred string, score double")
    position = len(kept.columns)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lut = model.slots()
        for batch in batches:
            texts, pred, scores = encoded(batch.column(position)), [], []
            for at in range(0, len(texts), block):
                part = texts[at : at + block]
                out = np.clip(model.features(part, lut) @ model.weights, 1e-6, 1) if model.labels else np.zeros((len(part), 0))
                for t, row in zip(part, out, strict=True):
                    known = len(row) and has_letter(t)
                    best = int(row.argmax()) if known else -1
                    pred.append(model.labels[best] if known else UNDETERMINED)
                    scores.append(float(row[best] / row.sum()) if known else 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:position], pa.array(pred, pa.string()), pa.array(scores, pa.float64())], names=schema.names)

    return source.mapInArrow(score, schema)
