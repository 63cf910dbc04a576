"""Quality classifier: naive-Bayes support vectors over n-gram indicators.

Indicators (does the text hold the n-gram?) are scaled by log-count ratios of the two classes, and a linear
hinge-loss model is fitted on them by dual coordinate descent.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskloom.llm.hashing import gram_hashes, mixed, word_hashes
from maskloom.llm.tables import map_batches, schema_text, text_blocks

SPACES = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def shapes(word: np.ndarray, word_row: np.ndarray, count: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(hash, text number) of what invented words cannot show: which of five words in a row repeat the one before,
    and, in sixteenths, how many words do so and how many come twice in their text."""
    again = np.zeros(len(word), bool)
    again[1:] = (word[1:] == word[:-1]) & (word_row[1:] == word_row[:-1])
    run = np.zeros(max(len(word) - 4, 0), np.uint64)
    for place in range(5):
        run = run * np.uint64(2) + again[place : place + len(run)]
    whole = word_row[: len(run)] == word_row[4:] if len(run) else np.zeros(0, bool)
    held = np.maximum(np.bincount(word_row, minlength=count), 1)
    order = np.lexsort((word, word_row))
    twice = (word[order][1:] == word[order][:-1]) & (word_row[order][1:] == word_row[order][:-1])
    shares = [np.bincount(word_row, again, count) / held, np.bincount(word_row[order][1:], twice, count) / held]
    size = np.minimum(np.log2(held).astype(np.uint64), 6)
    rows = np.arange(count)
    found = [(mixed(run[whole] + np.uint64(1000)), word_row[: len(run)][whole])]
    for at, share in enumerate(shares):
        level = np.uint64(2000 * (at + 1)) + size * np.uint64(100 * at) + (share * 16).astype(np.uint64)
        found.append((mixed(level), rows))
    return found


def indicators(texts: list[bytes], bits: int) -> list[np.ndarray]:
    """For each text the sorted buckets of its words, word pairs, 3-byte runs and repeat shapes."""
    word, word_row, _ = word_hashes(texts, SPACES)
    paired = word_row[1:] == word_row[:-1]
    pair = mixed(word[:-1] * np.uint64(0x9E3779B97F4A7C15) + word[1:])[paired]
    gram, gram_row = gram_hashes(texts, 3)
    shift = np.uint64(64 - bits)
    parts = [(word, word_row), (pair, word_row[1:][paired]), (gram, gram_row), *shapes(word, word_row, len(texts))]
    parts = [((h >> shift).astype(np.int32), np.searchsorted(row, np.arange(len(texts) + 1))) for h, row in parts]
    seen, found = np.zeros(1 << bits, bool), []
    for i in range(len(texts)):
        held = np.concatenate([h[at[i] : at[i + 1]] for h, at in parts])
        seen[held] = True
        held = held[seen[held]]
        if len(held) * 12 > len(seen):
            held = np.flatnonzero(seen).astype(np.int32)
        else:
            held = np.unique(held)
        seen[held] = False
        found.append(held)
    return found


@dataclass(frozen=True)
class QualityModel:
    weights: np.ndarray
    bias: float
    slope: float
    shift: float
    bits: int

    def score(self, texts: list[bytes]) -> np.ndarray:
        held = indicators(texts, self.bits)
        sizes = np.array([len(h) for h in held])
        row = np.repeat(np.arange(len(held)), sizes)
        total = np.bincount(row, self.weights[np.concatenate(held)] if len(row) else None, len(held))
        margin = total / np.sqrt(np.maximum(sizes, 1)) + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -500, 500)))


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray, bits: int, smooth: float = 1.0) -> np.ndarray:
    counts = {k: np.full(1 << bits, smooth) for k in (0, 1)}
    for row, label in zip(rows, labels):
        counts[int(label)][row] += 1
    return np.log((counts[1] / counts[1].sum()) / (counts[0] / counts[0].sum()))


def dual_descent(rows: list[np.ndarray], scale: np.ndarray, labels: np.ndarray, cost: float = 1.0, epochs: int = 12, seed: int = 7) -> tuple[np.ndarray, float]:
    """Weights and bias of the L1-loss linear support vector machine, one dual variable at a time.

    A row's values are its scaled indicators over the root of their number, and 1 for the bias.
    """
    values = [scale[r] / np.sqrt(max(len(r), 1)) for r in rows]
    norms = np.array([v @ v + 1.0 for v in values])
    side = np.where(labels == 1, 1.0, -1.0)
    # Both classes weigh the same, however rare one is.
    limit = cost * np.where(labels == 1, 0.5 / max(labels.mean(), 1e-9), 0.5 / max(1 - labels.mean(), 1e-9))
    weights, bias, alpha = np.zeros(len(scale)), 0.0, np.zeros(len(rows))
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(len(rows)):
            slope = side[i] * (weights[rows[i]] @ values[i] + bias) - 1
            new = min(max(alpha[i] - slope / norms[i], 0.0), limit[i])
            step = (new - alpha[i]) * side[i]
            if step:
                weights[rows[i]] += step * values[i]
                bias += step
                alpha[i], moved = new, max(moved, abs(step))
        if moved < 1e-4:
            break
    return weights, bias


def _calibrated(margins: np.ndarray, labels: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and shift of a logistic curve through the margins, by Newton's method with a little ridge."""
    x = np.stack([margins, np.ones(len(margins))], 1)
    # Smoothed targets keep the curve finite when the classes are separable.
    good = labels.sum()
    target = np.where(labels == 1, (good + 1) / (good + 2), 1 / (len(labels) - good + 2))
    at = np.array([1.0, 0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        change = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (p - target) + 1e-3 * at)
        at -= np.clip(change, -2, 2)
    return max(float(at[0]), 1e-3), float(at[1])


def fit(rows: list[np.ndarray], labels: np.ndarray, bits: int, share: float | None = None) -> QualityModel:
    """A fifth of the rows is kept aside to turn margins into chances; ``share`` is that of label 1 outside the sample.

    Without both classes the score is constant.
    """
    labels = np.asarray(labels, int)
    aside = np.arange(len(labels)) % 5 == 4
    if len(labels) < 10 or not all(0 < labels[part].sum() < part.sum() for part in (aside, ~aside)):
        share = (labels.sum() + 1) / (len(labels) + 2)
        return QualityModel(np.zeros(1 << bits), 0.0, 1.0, float(np.log(share / (1 - share))), bits)
    train = [r for r, a in zip(rows, aside) if not a]
    scale = log_count_ratios(train, labels[~aside], bits)
    inner, bias = dual_descent(train, scale, labels[~aside])
    weights = inner * scale
    margins = np.array([weights[r].sum() / np.sqrt(max(len(r), 1)) + bias for r, a in zip(rows, aside) if a])
    slope, shift = _calibrated(margins, labels[aside])
    if share is not None and 0 < share < 1:
        here = labels[aside].mean()
        shift += float(np.log(share / (1 - share)) - np.log(here / (1 - here)))
    return QualityModel(weights, bias, slope, shift, bits)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def fit_table(docs: DataFrame, labels: DataFrame, limit: int = 4_000, bits: int = 18, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> QualityModel:
    """The model of the labelled rows outside the held-out fifth.

    At most ``limit`` labelled ids are used, in hash order, and of each class half as far as there are enough; the
    sample fits the model only. Rows with a null id or label are no examples; a document or label row that comes
    twice counts twice.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where(F.col("label").isin(0, 1) & F.col("id").isNotNull() & ~held_out(F.col("id")))
    order = (F.xxhash64("id", F.lit("quality")), "id")
    sample = known.where("label = 0").orderBy(*order).limit(limit // 2).unionByName(known.where("label = 1").orderBy(*order).limit(limit // 2))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [h.tobytes() for _, block in text_blocks(batch.column(2)) for h in indicators(block, bits)]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.string()), batch.column(1), pa.array(held, pa.binary())], ["id", "label", "held"])

    joined = texts.join(F.broadcast(sample), "id").select("id", "label", "text")
    found = map_batches(joined, rows_of, "id string, label int, held binary").orderBy(F.xxhash64("id"), "id").limit(2 * limit).collect()
    share = known.agg(F.avg("label")).first()[0]
    return fit([np.frombuffer(r.held, np.int32) for r in found], np.array([r.label for r in found]), bits, share)


def score(docs: DataFrame, model: QualityModel, cut: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``held_out``, ``score`` (chance of label 1) and ``predicted``.

    Null text is scored as an empty one, whose only feature is the bias. Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = np.concatenate([np.zeros(0), *(shared.value.score(block) for _, block in text_blocks(batch.column(1)))])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p)], [id_col, "score"])

    rows = docs.select(id_col, text_col)
    found = map_batches(rows, scored, f"`{id_col}` {rows.schema[0].dataType.simpleString()}, score double")
    return found.select(id_col, held_out(F.col(id_col)).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: QualityModel, cut: float = 0.3, text_col: str = "text") -> DataFrame:
    """The documents whose score is ``cut`` or more, with all their columns."""
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, block in text_blocks(batch.column(at)):
                yield batch.slice(start, len(block)).filter(pa.array(shared.value.score(block) >= cut))

    return map_batches(docs, chosen, schema_text(docs))
