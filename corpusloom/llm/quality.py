"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

Statistics of the whole text are standardised and mapped to random Fourier
features (an approximation of a Gaussian kernel).  Ridge scores come from
normal equations summed over the partitions, in folds, so that the isotonic
calibration is fitted on scores of rows that the fold's weights haven't seen.

Defined results: null and empty texts have all-zero statistics and a score like
any other; a document without a label teaches nothing; of several labels of one
document each counts; a null id has no label; texts of any length count whole; with no labelled row at all every score is 0.5;
given columns named ``score`` or ``predicted`` are replaced, all others stay, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import SPACE, checkpoint, encoded, plus, quoted, summed

STATISTICS = [
    "log_bytes", "log_words", "mean_word", "sd_word", "unique_words", "top_word", "upper", "digit", "space", "ascii_punct",
    "symbol", "pipe", "bang", "comma_stop", "newline", "high_byte", "byte_entropy", "deflate", "unique_lines", "upper_words", "short_words", "long_words",
]
_CLASS = np.zeros((256, 9), np.float64)
for _k, _chars in enumerate((range(65, 91), range(48, 58), (32, 9, 11, 12, 13), (*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)), b"#$%&*<>@^_~{}[]\\", b"|", b"!", b",.;:", b"\n")):
    _CLASS[list(_chars), _k] = 1
_HIGH = np.arange(256) > 127


def statistics(text: bytes) -> list[float]:
    """The statistics of one text, in the order of ``STATISTICS``."""
    if not text:
        return [0.0] * len(STATISTICS)
    x = np.frombuffer(text, np.uint8)
    counts = np.bincount(x, minlength=256).astype(np.float64)
    n = len(x)
    share = counts[counts > 0] / n
    inside = np.zeros(n + 2, np.int8)
    inside[1:-1] = ~SPACE[x]
    step = np.diff(inside)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    length = ends - starts
    words = text.split()
    m = max(1, len(words))
    distinct: dict[bytes, int] = {}
    for w in words:
        distinct[w] = distinct.get(w, 0) + 1
    lines = [s for s in text.split(b"\n") if s.strip()]
    upper = (x >= 65) & (x < 91)
    first = upper[starts] & upper[np.minimum(starts + 1, n - 1)] & (length > 1) if len(starts) else np.zeros(0, bool)
    return [
        np.log1p(n), np.log1p(len(words)), float(length.mean()) if len(length) else 0.0, float(length.std()) if len(length) else 0.0, len(distinct) / m, max(distinct.values(), default=0) / m,
        *(counts @ _CLASS / n).tolist(), float(counts[_HIGH].sum() / n), float(-(share * np.log2(share)).sum()), len(zlib.compress(text, 1)) / n,
        len(set(lines)) / max(1, len(lines)), float(first.sum() / m), float((length <= 3).sum() / m), float((length >= 12).sum() / m),
    ]


def with_statistics(rows: DataFrame) -> DataFrame:
    """``rows`` with an array ``stats`` of each row's whole text in place of their last column, which is the text."""
    n = len(rows.columns) - 1
    schema = plus(rows.select(*map(quoted, rows.columns[:n])), "stats array<double>")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = pa.array([statistics(t) for t in encoded(batch.column(n))], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], stats], names=schema.names)

    return rows.mapInArrow(run, schema)


def isotonic(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The non-decreasing sequence nearest to ``values`` (pool adjacent violators)."""
    blocks: list[list[float]] = []
    for v, w in zip(values, weights, strict=True):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            b, a = blocks.pop(), blocks.pop()
            blocks.append([(a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], a[2] + b[2]])
    return np.concatenate([np.full(int(n), v) for v, _, n in blocks]) if blocks else np.zeros(0)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    omega: np.ndarray
    phase: np.ndarray
    weights: np.ndarray  #: of all rows
    knots: np.ndarray  #: raw scores, ascending
    levels: np.ndarray  #: calibrated scores at the knots

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -8, 8)
        return np.hstack([np.cos(z @ self.omega + self.phase) * np.sqrt(2 / len(self.phase)), np.ones((len(z), 1))])

    def score(self, stats: np.ndarray) -> np.ndarray:
        if not len(self.knots):
            return np.full(len(stats), 0.5)
        return np.clip(np.interp(self.features(stats) @ self.weights, self.knots, self.levels), 0, 1)


def _stacked(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(STATISTICS))


def fit(train: DataFrame, features: int = 192, gamma: float = 0.04, ridge: float = 1e-4, folds: int = 4, bins: int = 2000, seed: int = 5) -> Model:
    """A model of ``train`` (``stats``, ``label``, ``fold`` in 0 .. folds - 1).

    Features, folds and calibration bins are parameters of a fixed size; every row counts.
    """
    d = len(STATISTICS)
    moments = train.select(*(f(F.col("stats")[i]).alias(f"{n}{i}") for i in range(d) for n, f in (("m", F.avg), ("s", F.stddev_pop)))).first()
    if moments.m0 is None:
        return Model(*(np.zeros(0) for _ in range(7)))
    rng = np.random.default_rng(seed)
    model = Model(np.array([moments[f"m{i}"] for i in range(d)]), np.maximum([moments[f"s{i}"] for i in range(d)], 1e-6), rng.normal(0, np.sqrt(2 * gamma), (d, features)), rng.uniform(0, 2 * np.pi, features), np.zeros(0), np.zeros(0), np.zeros(0))
    width = features + 1
    rows = train.select("stats", F.col("label").cast("double").alias("label"), F.col("fold").cast("int").alias("fold"))

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((folds, width, width + 1))
        for batch in batches:
            x, y, k = model.features(_stacked(batch.column(0))), batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for f in range(folds):
                a = x[k == f]
                total[f] += a.T @ np.column_stack([a, y[k == f]])
        yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], ["blob"])

    total = summed(rows.mapInArrow(partial, "blob binary"), "blob", 4).reshape(folds, width, width + 1)
    solve = lambda t: np.linalg.solve(t[:, :width] + ridge * max(1.0, t[-1, width - 1]) * np.diag([*[1.0] * features, 1e-9]), t[:, width])
    model.weights = solve(total.sum(0))
    unseen = np.stack([solve(total.sum(0) - total[f]) for f in range(folds)])

    def binned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, bins + 1))
        for batch in batches:
            x, y, k = model.features(_stacked(batch.column(0))), batch.column(1).to_numpy(), batch.column(2).to_numpy()
            at = np.clip(np.rint(((x * unseen[k]).sum(1) + 0.5) / 2 * bins), 0, bins).astype(int)
            sums[0] += np.bincount(at, minlength=bins + 1)
            sums[1] += np.bincount(at, y, minlength=bins + 1)
        yield pa.record_batch([pa.array([sums.tobytes()], pa.binary())], ["blob"])

    n, positive = summed(rows.mapInArrow(binned, "blob binary"), "blob").reshape(2, bins + 1)
    there = n > 0
    model.levels = isotonic((positive[there] + 0.5 * positive.sum() / n.sum()) / (n[there] + 0.5), n[there])
    raw = (np.arange(bins + 1) / bins * 2 - 0.5)[there]
    # One knot for each level, in the middle of its bins: between levels the score rises steadily.
    _, first = np.unique(model.levels, return_index=True)
    last = [*first[1:], len(raw)]
    model.knots = np.array([raw[a:b].mean() for a, b in zip(first, last, strict=True)])
    model.levels = model.levels[first]
    return model


def score(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` with ``score`` in place of their last column ``stats``."""
    n = len(rows.columns) - 1
    schema = plus(rows.drop("stats"), "score double")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(model.score(_stacked(batch.column(n))), pa.float64())], names=schema.names)

    return rows.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, teaches: str, columns: list[str], threshold: float = 0.3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fit on the labelled rows where the boolean column ``teaches`` holds, and score every row: ``columns``, ``score``, ``predicted``.

    Statistics are taken once and checkpointed; only these narrow rows meet the labels.
    """
    names = [c for c in columns if c not in ("score", "predicted")]
    rows = docs.select(F.struct(*map(quoted, names)).alias("row"), quoted(key).alias("key"), quoted(teaches).alias("teaches"), quoted(text).alias("text"))
    stats = checkpoint(with_statistics(rows))
    known = labels.select(F.col("doc_id").alias("key"), F.col("quality").alias("label")).where("label is not null")
    train = stats.where("teaches").join(known, "key").withColumn("fold", F.pmod(F.xxhash64("key"), F.lit(4)))
    out = score(stats.select("row", "stats"), fit(train))
    return out.select(*(F.col(f"row.`{c}`") for c in names), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
