"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of a text (shares of character classes, lengths of words and lines, repetition) are cut into at most 64
bins by quantiles of the training rows. Trees grow by depth from gradient and hessian histograms. The trained trees are
flattened into arrays, so that scoring walks all rows of a batch through one tree level per numpy operation.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows that a model is trained on at most; beyond it, those with the smallest hash of their id are taken.
SAMPLE = 20_000
TREES, DEPTH, BINS, RATE, LAMBDA, MIN_HESSIAN = 80, 4, 64, 0.15, 1.0, 3.0

FEATURES = [
    "log_bytes", "log_words", "upper", "digit", "space", "newline", "control", "high", "stops", "quotes", "brackets",
    "bars", "symbols", "marks", "slashes", "entropy", "mean_word", "long_words", "one_letter", "plain_words", "shouted",
    "capitalised", "distinct", "top_word", "top_five", "mean_line", "distinct_lines", "repeated_line_share",
    "short_lines", "lines_end_stop", "words_with_symbol", "longest_word",
]


def _classes() -> np.ndarray:
    """A row for each class of bytes."""
    groups = [
        b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n\r", bytes([*range(9), 11, 12, *range(14, 32), 127]), bytes(range(128, 256)),
        b".,;:", b"\"'`", b"()[]{}<>", b"|_=~", b"#$%&*+^@", b"!?", b"/\\-",
    ]
    out = np.zeros((len(groups), 256))
    for i, g in enumerate(groups):
        out[i, list(g)] = 1
    return out


_CLASSES = _classes()
_SYMBOLS = set("#$%&*+^@|_=~<>{}[]\\/")


def statistics(text: str | None) -> list[float]:
    """The features of one text; a null text counts as empty, for which all are 0."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    if not raw:
        return [0.0] * len(FEATURES)
    n = len(raw)
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    share = count / n
    words = text.split()
    lines = [x for x in text.split("\n") if x.strip()]
    seen = share[share > 0]
    out = [float(np.log1p(n)), float(np.log1p(len(words))), *(_CLASSES @ share).tolist(), float(-(seen * np.log2(seen)).sum())]
    w = max(1, len(words))
    bare = [x.strip(".,;:!?\"'()") for x in words]
    tally = Counter(bare)
    common = [k for _, k in tally.most_common(5)]
    out += [
        sum(map(len, bare)) / w, sum(len(x) > 14 for x in bare) / w, sum(len(x) <= 1 for x in bare) / w, sum(map(str.isalpha, bare)) / w,
        sum(len(x) > 1 and x.isupper() for x in bare) / w, sum(map(str.istitle, bare)) / w, len(tally) / w,
        (common[0] if common else 0) / w, sum(common) / w,
    ]
    k = max(1, len(lines))
    found = Counter(lines)
    out += [
        sum(map(len, lines)) / k, len(found) / k, sum(c for c in found.values() if c > 1) / k, sum(len(x) < 40 for x in lines) / k,
        sum(x.rstrip()[-1] in ".!?" for x in lines) / k, sum(not _SYMBOLS.isdisjoint(x) for x in words) / w, float(np.log1p(max(map(len, bare), default=0))),
    ]
    return out


def matrix(texts: list[str | None]) -> np.ndarray:
    return np.array([statistics(t) for t in texts]).reshape(len(texts), len(FEATURES))


@dataclass
class Trees:
    """Flattened trees: node ``i`` of all trees sends rows with feature > threshold to child + 1, others to child.

    A leaf is its own child with an infinite threshold, so every row makes the same number of steps.
    """

    base: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    child: np.ndarray
    value: np.ndarray
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 of each row."""
        total, rows = np.full(len(x), self.base), np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                node = self.child[node] + (x[rows, self.feature[node]] > self.threshold[node])
            total += self.value[node]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE) -> Trees:
    """Train on rows ``x`` with labels ``y``; without both labels the score is the labels' share, 0.5 without any."""
    share = (y.sum() + 1e-3) / (len(y) + 2e-3)
    base = float(np.log(share / (1 - share)))
    feature, threshold, child, value, roots = [], [], [], [], []
    if len(y) == 0 or y.min() == y.max():
        return Trees(base if len(y) else 0.0, np.empty(0, np.int64), np.zeros(1, np.int64), np.zeros(1), np.zeros(1, np.int64), np.zeros(1), 0)
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T, strict=True)], 1)  # bin <= k: value <= cut k
    width, n_features = BINS, x.shape[1]
    flat = binned + np.arange(n_features) * width
    total = np.full(len(y), base)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        grad, hess = p - y, np.maximum(p * (1 - p), 1e-6)
        roots.append(len(feature))
        todo = [(np.arange(len(y)), 0, _node(feature, threshold, child, value))]
        while todo:
            rows, level, me = todo.pop()
            g, h = grad[rows].sum(), hess[rows].sum()
            value[me] = -rate * g / (h + LAMBDA)
            found = None
            if level < depth and h >= 2 * MIN_HESSIAN:
                at = flat[rows].ravel()
                gl = np.bincount(at, np.repeat(grad[rows], n_features), n_features * width).reshape(n_features, width).cumsum(1)
                hl = np.bincount(at, np.repeat(hess[rows], n_features), n_features * width).reshape(n_features, width).cumsum(1)
                gain = gl**2 / (hl + LAMBDA) + (g - gl) ** 2 / (h - hl + LAMBDA) - g**2 / (h + LAMBDA)
                gain[(hl < MIN_HESSIAN) | (h - hl < MIN_HESSIAN)] = 0
                f, k = np.unravel_index(gain.argmax(), gain.shape)
                found = (int(f), int(k)) if gain[f, k] > 1e-6 and k < len(cuts[f]) else None
            if not found:
                total[rows] += value[me]
                continue
            f, k = found
            left, right = _node(feature, threshold, child, value), _node(feature, threshold, child, value)
            feature[me], threshold[me], child[me] = f, float(cuts[f][k]), left
            low = binned[rows, f] <= k
            todo += [(rows[~low], level + 1, right), (rows[low], level + 1, left)]
    return Trees(base, np.array(roots), np.array(feature), np.array(threshold), np.array(child), np.array(value), depth)


def _node(feature: list, threshold: list, child: list, value: list) -> int:
    me = len(feature)
    feature.append(0)
    threshold.append(np.inf)
    child.append(me)
    value.append(0.0)
    return me


def fold(doc_id: Column) -> Column:
    """The fold, 0 to 2, of a row: crc32 of its id as text, modulo 3; a null id is in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3, F.lit(0))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, held_out: int = 1) -> Trees:
    """Train on at most ``sample`` labelled documents outside fold ``held_out``.

    Labels of null ids and null labels are left out; of rows with one id, the smallest label and text statistics
    count. What reaches the driver is bounded by ``sample`` rows of statistics.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("quality").cast("int").alias("_label")).where("_id is not null and _label in (0, 1)")
    known = known.where(fold(F.col("_id")) != held_out).groupBy("_id").agg(F.min("_label").alias("_label"))
    known = known.orderBy(F.xxhash64("_id"), "_id").limit(sample)
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("_text"))
    rows = rows.join(F.broadcast(known), "_id").groupBy("_id", "_label").agg(F.min("_text").alias("_text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = matrix([t if isinstance(t, str) else None for t in b["_text"]])
            yield pd.DataFrame({"_id": b["_id"], "y": b["_label"], "x": list(x)})

    got = rows.mapInPandas(run, "_id long, y int, x array<double>").toPandas().sort_values("_id")
    x = np.array(got["x"].tolist()).reshape(len(got), len(FEATURES))
    return fit(x, got["y"].to_numpy(float))


def classify(docs: DataFrame, model: Trees, keep: list[str] | None = None) -> DataFrame:
    """Score every whole text.

    A null text counts as empty; every row gets a score. Columns named in ``keep`` pass through unchanged, others are
    ignored; repeated rows and null ids are scored like any; an empty table gives an empty result. Map-only.

    Returns the kept columns (``doc_id`` by default), ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on).
    """
    keep = keep or ["doc_id"]
    fields = ["_text", *(f"_k{i}" for i in range(len(keep)))]
    rows = docs.select(F.col("text").cast("string").alias("_text"), *(F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            score = np.empty(b.num_rows)
            texts = b.column("_text")
            for at in range(0, b.num_rows, 1000):
                score[at : at + 1000] = model.score(matrix(texts.slice(at, 1000).to_pylist()))
            arrays = [b.column(f) for f in fields[1:]] + [pa.array(score), pa.array((score >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(arrays, [*fields[1:], "score", "predicted"])

    kinds = dict(rows.dtypes)
    out = rows.mapInArrow(run, ", ".join(f"{f} {kinds[f]}" for f in fields[1:]) + ", score double, predicted int")
    return out.select(*(F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)), "score", "predicted")
