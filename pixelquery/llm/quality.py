"""Quality classifier: an additive model of one- and two-feature lookup tables."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import combinations
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pixelquery.llm.text import fresh, remainder

FEATURES = (
    "log_words", "word_length", "upper", "digits", "symbols", "exclamations", "stops", "beyond_ascii",
    "line_words", "equal_neighbours", "different_words", "equal_lines",
)
_SPACES = np.frombuffer(b" \t\n\v\f\r", np.uint8)


def text_features(text: str | None) -> list[float]:
    """Counts and shares of one whole text; of an empty or null one, zeros."""
    raw = (text or "").encode("utf-8", "replace")
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    listed = raw.split()
    n, size = len(listed), len(raw) - int(count[_SPACES].sum())
    if not n:
        return [0.0] * len(FEATURES)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    share = 1.0 / size
    return [
        np.log1p(n),
        size / n,
        count[65:91].sum() * share,
        count[48:58].sum() * share,
        count[np.frombuffer(b"#*$%&|<>", np.uint8)].sum() * share,
        count[33] * share,
        count[np.frombuffer(b".,;:?", np.uint8)].sum() * share,
        count[128:].sum() * share,
        np.log1p(n / max(1, len(lines))),
        sum(map(eq, listed, listed[1:])) / n,
        len(set(listed)) / n,
        1.0 - len(set(lines)) / max(1, len(lines)),
    ]


@dataclass
class AdditiveModel:
    """``score = sigmoid(start + sum of table[bin])`` over features and chosen pairs of features."""

    edges: list[np.ndarray]
    coarse: list[np.ndarray]
    start: float
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def logits(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        for f, table in enumerate(self.tables):
            total += table[np.searchsorted(self.edges[f], x[:, f], side="right")]
        for (a, b), table in zip(self.pairs, self.pair_tables):
            at = [np.searchsorted(self.coarse[f], x[:, f], side="right") for f in (a, b)]
            total += table[at[0], at[1]]
        return total

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.logits(x), -30, 30)))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _cut(g: np.ndarray, h: np.ndarray, calm: float) -> tuple[float, int]:
    """Gain and place of the best cut of a row of bins; place 0 if there is none."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl**2 / (hl + calm) + gr**2 / (hr + calm) - g.sum() ** 2 / (h.sum() + calm)
    at = int(np.argmax(gain))
    return float(gain[at]), at + 1 if gain[at] > 1e-9 else 0


def _tree(g: np.ndarray, h: np.ndarray, calm: float, depth: int = 2) -> np.ndarray:
    """Leaf values of a shallow tree over ordered bins."""
    at = _cut(g, h, calm)[1] if depth else 0
    if not at:
        return np.full(len(g), g.sum() / (h.sum() + calm))
    return np.concatenate([_tree(g[:at], h[:at], calm, depth - 1), _tree(g[at:], h[at:], calm, depth - 1)])


def _pair_tree(g: np.ndarray, h: np.ndarray, calm: float) -> tuple[float, np.ndarray]:
    """Gain and leaf values of the best cut of one feature, each side cut by the other feature."""
    best: tuple[float, np.ndarray] = (-1.0, np.zeros_like(g))
    for turned in (False, True):
        u, v = (g.T, h.T) if turned else (g, h)
        for at in range(1, len(u)):
            gain, rows = 0.0, []
            for part in (slice(0, at), slice(at, None)):
                gs, hs = u[part].sum(0), v[part].sum(0)
                gain += _cut(gs, hs, calm)[0] + gs.sum() ** 2 / (hs.sum() + calm)
                rows.append(np.repeat(_tree(gs, hs, calm, 1)[None], len(u[part]), 0))
            if gain > best[0]:
                values = np.concatenate(rows)
                best = gain, values.T if turned else values
    return best


def fit(
    x: np.ndarray, y: np.ndarray, rounds: int = 120, pair_rounds: int = 30, pairs: int = 6, bins: int = 48,
    pair_bins: int = 8, rate: float = 0.1, calm: float = 5.0,
) -> AdditiveModel:
    """Cyclic boosting: in each round every feature in turn gets one shallow tree on the residuals.

    A tree over the bins of one feature is added to that feature's table, so the sum of all rounds stays
    one table per feature.  Then the pairs that explain most of what is left get tables of their own in
    the same way.  Without rows, or with one label only, the score is the smoothed share of label 1.
    """
    start = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    n_features = x.shape[1]
    if len(y) == 0 or y.min() == y.max():
        return AdditiveModel([np.empty(0)] * n_features, [], start, [np.zeros(1)] * n_features)
    edges = [_edges(x[:, f], bins) for f in range(n_features)]
    coarse = [_edges(x[:, f], pair_bins) for f in range(n_features)]
    fine = [np.searchsorted(edges[f], x[:, f], side="right") for f in range(n_features)]
    rough = [np.searchsorted(coarse[f], x[:, f], side="right") for f in range(n_features)]
    model = AdditiveModel(edges, coarse, start, [np.zeros(len(e) + 1) for e in edges])
    total = np.full(len(y), start)

    def residuals() -> tuple[np.ndarray, np.ndarray]:
        p = 1.0 / (1.0 + np.exp(-np.clip(total, -30, 30)))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for f in range(n_features):
            g, h = (np.bincount(fine[f], v, len(edges[f]) + 1) for v in residuals())
            step = rate * _tree(g, h, calm)
            model.tables[f] += step
            total += step[fine[f]]

    def grid(a: int, b: int) -> tuple[tuple[int, int], np.ndarray]:
        shape = len(coarse[a]) + 1, len(coarse[b]) + 1
        return shape, rough[a] * shape[1] + rough[b]

    def pair_step(a: int, b: int) -> tuple[float, np.ndarray]:
        shape, cell = grid(a, b)
        g, h = (np.bincount(cell, v, shape[0] * shape[1]).reshape(shape) for v in residuals())
        return _pair_tree(g, h, calm)

    gains = {pair: pair_step(*pair)[0] for pair in combinations(range(n_features), 2)}
    model.pairs = sorted(gains, key=lambda pair: (-gains[pair], pair))[:pairs]
    model.pair_tables = [np.zeros(grid(*pair)[0]) for pair in model.pairs]
    for _ in range(pair_rounds):
        for table, pair in zip(model.pair_tables, model.pairs):
            step = rate * pair_step(*pair)[1]
            table += step
            total += step.ravel()[grid(*pair)[1]]
    return model


def training_rows(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, most: int) -> pd.DataFrame:
    """Features and labels of at most ``most`` labelled documents, those with the smallest id hashes.

    Documents whose id's crc32 leaves 2 modulo 4 are held out.  Rows without an id or a label are left
    out.  Only numbers reach the driver.
    """
    drawn = labels.where(F.col("quality").isNotNull() & (remainder("doc_id", 4) != 2))
    drawn = drawn.select(F.col("doc_id").alias("_id"), F.col("quality").cast("double").alias("_label"))
    order = F.xxhash64("_id"), F.col("_id"), F.col("_label")
    drawn = drawn.orderBy(*order).limit(most)
    rows = docs.select(F.col(doc_id).alias("_doc"), F.col(text).alias("_text"))
    rows = rows.join(F.broadcast(drawn), F.col("_doc") == F.col("_id"))

    def features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [text_features(v.as_py()) for v in batch.column("_text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_label"), pa.array(x, pa.list_(pa.float64()))],
                ["_id", "_label", "x"],
            )

    measured = rows.select(F.col("_id").cast("long"), "_label", "_text").mapInArrow(
        features, "_id BIGINT, _label DOUBLE, x ARRAY<DOUBLE>"
    )
    return measured.orderBy(F.xxhash64("_id"), "_id", "_label", "x").limit(most).toPandas()


def train(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", most: int = 20_000
) -> AdditiveModel:
    """Fit on a bounded sample of labelled documents (``most``, see ``training_rows``)."""
    rows = training_rows(docs, labels, doc_id, text, most)
    x = np.array(rows["x"].tolist(), float).reshape(len(rows), len(FEATURES))
    return fit(x, rows["_label"].to_numpy(float))


def scored(docs: DataFrame, model: AdditiveModel, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with all its columns and ``score``, from each whole text alone.

    Null and empty texts are scored as having all features 0.  Rows stay as they are, repeated ones and
    those with null ids too; nothing is shuffled.  A column called ``score`` is replaced.
    """
    kept = [c for c in docs.columns if c.lower() != score.lower()]
    place = kept.index(next(c for c in kept if c.lower() == text.lower()))

    def score_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([text_features(v.as_py()) for v in batch.column(place)]).reshape(-1, len(FEATURES))
            values = pa.array(model.scores(x), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, values], [*batch.schema.names, score])

    fields = docs.select(*kept).schema.add(score, "double")
    return docs.select(*kept).mapInArrow(score_rows, fields)


def is_held_out(doc_id: Column | str) -> Column:
    return F.coalesce(remainder(doc_id, 4) == 2, F.lit(False))


def accepted(docs: DataFrame, labels: DataFrame, least: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that the classifier trained on ``labels`` doesn't reject."""
    score = fresh(docs, "score")
    return scored(docs, train(docs, labels), score=score).where(F.col(score) >= least).drop(score)
