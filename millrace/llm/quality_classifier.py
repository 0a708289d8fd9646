"""Quality classifier: regularised quadratic discriminant over transformed document statistics."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm._base import Scratch

FEATURES = (
    "log_words", "word_len", "word_len_spread", "symbol_rate", "upper_rate", "digit_rate", "punct_rate", "bang_rate",
    "line_len", "dup_line_rate", "distinct_rate", "top_word_rate", "repeat_pair_rate", "lone_mark_rate", "stop_rate",
)
#: Function words of English, French, German and Spanish.
STOP = frozenset(
    "the of and to in is it that for as with was on are by this be at from or an a had has not have le la les de des du"
    " un une et en est que qui dans pour sur pas par plus avec au aux ce se der die das und ist von zu den mit sich des"
    " auf ein eine nicht als auch es im dem el los las y del por con una su para al lo como más o pero sus".split()
)
_UPPER = re.compile(r"[^\W\d_a-zß-öø-ÿ]")


def _logit(x: float, n: float) -> float:
    """Log-odds of a rate, drawn to the middle by half an observation."""
    a = x + 0.5
    b = max(n - x, 0) + 0.5
    return float(np.log(a / b))


def document_features(text: str | None) -> list[float]:
    """Fifteen statistics, each transformed (logs and log-odds) so that class distributions come close to normal."""
    text = text or ""
    n = len(text)
    words = text.split()
    k = len(words)
    lengths = np.fromiter(map(len, words), np.float64, k) if k else np.zeros(1)
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    lines = [x for x in text.split("\n") if x.strip()]
    pairs = list(zip(words, words[1:], strict=False))
    marks = sum(v for w, v in counts.items() if not any(c.isalnum() for c in w))
    stop = sum(v for w, v in counts.items() if w.lower().strip(".,;:!?|#*$%&<>\"'()") in STOP)
    return [
        float(np.log1p(k)),
        float(np.log1p(lengths.mean())),
        float(np.log1p(lengths.std())),
        _logit(sum(map(text.count, "#*$%&|<>")), n),
        _logit(sum(1 for c in text if c.isupper()), n),
        _logit(sum(map(text.count, "0123456789")), n),
        _logit(sum(map(text.count, ".,;:?")), n),
        _logit(text.count("!"), n),
        float(np.log1p(n / max(1, len(lines)))),
        _logit(len(lines) - len(set(lines)), len(lines)),
        _logit(len(counts), k),
        _logit(max(counts.values(), default=0), k),
        _logit(len(pairs) - len(set(pairs)), len(pairs)),
        _logit(marks, k),
        _logit(stop, k),
    ]


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [document_features(t) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], names=["doc_id", "x"])


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each class in a task: count, sums and sums of products, of features about a fixed centre."""
    d = len(FEATURES)
    acc = {y: [0, np.zeros(d), np.zeros((d, d))] for y in (0, 1)}
    for batch in batches:
        x = np.array(batch.column(0).to_pylist(), np.float64).reshape(-1, d)
        y = np.asarray(batch.column(1).to_pylist())
        for k, a in acc.items():
            own = x[y == k]
            a[0] += len(own)
            a[1] += own.sum(0)
            a[2] += own.T @ own
    got = [(k, a) for k, a in acc.items() if a[0]]
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([k for k, _ in got], pa.int32()),
            pa.array([a[0] for _, a in got], pa.int64()),
            pa.array([np.concatenate([a[1], a[2].ravel()]).tolist() for _, a in got], pa.list_(pa.float64())),
        ],
        names=["label", "n", "sums"],
    )


@dataclass(frozen=True)
class Discriminant:
    """Means, cached Cholesky factors of the shrunken covariances, their log-determinants, and log priors."""

    means: np.ndarray
    factors: np.ndarray
    log_dets: np.ndarray
    log_priors: np.ndarray
    usable: bool

    def score(self, x: np.ndarray) -> np.ndarray:
        """P(label 1): the logistic function of the difference of log densities by Mahalanobis distance plus priors."""
        if not self.usable:
            return np.full(len(x), float(np.exp(self.log_priors[1])))
        logs = []
        for k in (0, 1):
            z = np.linalg.solve(self.factors[k], (x - self.means[k]).T)
            logs.append(self.log_priors[k] - 0.5 * (self.log_dets[k] + (z * z).sum(0)))
        return 1 / (1 + np.exp(-np.clip(logs[1] - logs[0], -30, 30)))


def fit(n: np.ndarray, sums: np.ndarray, squares: np.ndarray, *, to_pooled: float = 0.2, to_sphere: float = 0.05) -> Discriminant:
    """From class counts, sums and sums of products. A class covariance is drawn towards the pooled one by
    ``to_pooled`` and then towards its own diagonal by ``to_sphere``, and floored, so it always has a Cholesky factor."""
    d = sums.shape[1]
    priors = np.log((n + 1) / (n.sum() + 2))
    usable = bool((n >= 2).all())
    if not usable:
        return Discriminant(np.zeros((2, d)), np.stack([np.eye(d)] * 2), np.zeros(2), priors, False)
    means = sums / n[:, None]
    scatter = squares - n[:, None, None] * means[:, :, None] * means[:, None, :]
    pooled = scatter.sum(0) / max(1, n.sum() - 2)
    factors, dets = [], []
    for k in (0, 1):
        own = scatter[k] / max(1, n[k] - 1)
        cov = (1 - to_pooled) * own + to_pooled * pooled
        cov = (1 - to_sphere) * cov + to_sphere * np.diag(np.diag(cov)) + 1e-4 * np.eye(d)
        low = np.linalg.cholesky(cov)
        factors.append(low)
        dets.append(2 * np.log(np.diag(low)).sum())
    return Discriminant(means, np.stack(factors), np.array(dets), priors, True)


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    cut: float = 0.3,
) -> DataFrame:
    """One row per input row: ``doc_id, held_out, score, predicted``.

    Only labels of rows whose crc32(identifier as text) mod 5 is not 0 are learnt. Features come from the text alone.
    The fit is exact over all such labels: each task sums moments, and the driver adds at most two rows a task of
    fixed width (d + d * d numbers). Texts are read once; only features are joined with labels.

    Null text is empty and is scored; a null identifier is not held out and has no label; null labels and labels other
    than 0 and 1 are ignored; repeated rows and labels count as often as they occur. Without two labels of either class
    every score is the smoothed share of label 1. Other columns are ignored.
    """
    spark = docs.sparkSession
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    features = Scratch(spark, "qda").save(base.mapInArrow(_featurise, "doc_id long, x array<double>"), "features")
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y"))
    known = known.where(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & ~held)
    rows = features.join(known, "doc_id").select("x", "y").mapInArrow(_moments, "label int, n long, sums array<double>")
    d = len(FEATURES)
    n, sums, squares = np.zeros(2), np.zeros((2, d)), np.zeros((2, d, d))
    added = rows.groupBy("label").agg(
        F.sum("n").alias("n"), *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(d + d * d)]
    )
    for r in added.collect():  # two rows
        got = np.array([r[f"s{i}"] for i in range(d + d * d)])
        n[r["label"]], sums[r["label"]], squares[r["label"]] = r["n"], got[:d], got[d:].reshape(d, d)
    model = fit(n, sums, squares)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column(2).to_pylist(), np.float64).reshape(-1, d)
            score = model.score(x)
            cols = [batch.column(0), batch.column(1), pa.array(score), pa.array((score >= cut).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "held_out", "score", "predicted"])

    return features.select("doc_id", held.alias("held_out"), "x").mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int"
    )
