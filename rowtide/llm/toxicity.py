"""Toxicity grades: cumulative-link ordinal regression on sparse text features."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LETTERS = re.compile(r"[^\W\d_]+")
#: Prefix lengths that are features beside the whole word: languages that inflect or compound share stems.
STEMS = (4, 5, 6)


def word_slots(word: str, bits: int) -> tuple[int, ...]:
    """Hash slots of a lower-case word: the word itself and its stems."""
    names = {"=" + word} | {f"{k}{word[:k]}" for k in STEMS if len(word) >= k}
    return tuple(xxhash.xxh64_intdigest(n.encode("utf-8", "replace")) >> (64 - bits) for n in sorted(names))


def words_in(text: str | None) -> set[str]:
    """Distinct words of letters, lower-cased."""
    return set(_LETTERS.findall((text or "").lower()))


@dataclass
class OrdinalModel:
    """P(grade > k) = logistic(w . x - cut_k): one weight vector for all ordered cuts. ``weights`` holds the slots that count."""

    weights: dict[int, float]
    cuts: list[float]
    bits: int
    #: Least score that counts as toxic, from sampled texts the weights were not fitted on.
    least: float = 0.0

    def word(self, word: str) -> float:
        return sum(self.weights.get(s, 0.0) for s in word_slots(word, self.bits))

    def over(self, score: float) -> list[float]:
        return [1.0 / (1.0 + float(np.exp(-np.clip(score - c, -60, 60)))) for c in self.cuts]


def _likelihood(score: np.ndarray, cuts: np.ndarray, grades: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slope of the log likelihood: per text along its score, and per cut."""
    p = 1 / (1 + np.exp(-np.clip(score[:, None] - cuts[None, :], -40, 40)))
    upper = np.column_stack([np.ones(len(score)), p])
    lower = np.column_stack([p, np.zeros(len(score))])
    at = np.arange(len(score)), grades
    chance = np.maximum(upper[at] - lower[at], 1e-9)
    up, low = upper[at] * (1 - upper[at]) / chance, lower[at] * (1 - lower[at]) / chance
    by_cut = np.array([low[grades == k].sum() - up[grades == k + 1].sum() for k in range(len(cuts))])
    return up - low, by_cut


def _first_cuts(grades: np.ndarray, grades_n: int) -> np.ndarray:
    share = [min(0.999, max(0.001, float((grades > k).mean()))) if len(grades) else 0.001 for k in range(grades_n - 1)]
    cuts = -np.log(np.array(share) / (1 - np.array(share)))
    return np.maximum.accumulate(cuts + 0.01 * np.arange(len(cuts)))


def telling_slots(at: np.ndarray, slot: np.ndarray, grades: np.ndarray, slots: int, grades_n: int, least_z: float) -> np.ndarray:
    """Slots whose score test against the model without features reaches ``least_z`` standard errors."""
    slope, _ = _likelihood(np.zeros(len(grades)), _first_cuts(grades, grades_n), grades)
    slope = slope - slope.mean() if len(slope) else slope
    total, times = np.bincount(slot, slope[at], slots), np.bincount(slot, minlength=slots)
    spread = max(float(slope.std()), 1e-12) if len(slope) else 1.0
    return np.flatnonzero(np.abs(total) > least_z * spread * np.sqrt(np.maximum(times, 1)))


def fit_ordinal(
    rows: list[np.ndarray], grades: np.ndarray, slots: int, grades_n: int, steps: int = 400, shrink: float = 1e-4, least_z: float = 4.5
) -> tuple[np.ndarray, np.ndarray]:
    """Weights per slot and ordered cuts: accelerated proximal steps on the likelihood with an L1 pull.

    Only slots that pass the score test get a weight. Cuts stay ordered. ``rows`` lists the slots of each text.
    """
    n = len(rows)
    w, cuts = np.zeros(slots), _first_cuts(grades, grades_n)
    at = np.repeat(np.arange(n), [len(r) for r in rows])
    slot = np.concatenate(rows).astype(np.int64) if n else np.empty(0, np.int64)
    if not len(slot):
        return w, cuts
    kept = telling_slots(at, slot, grades, slots, grades_n, least_z)
    number = np.full(slots, -1, np.int64)
    number[kept] = np.arange(len(kept))
    found = number[slot]
    at, slot = at[found >= 0], found[found >= 0]
    if not len(kept):
        return w, cuts
    u = np.ones(len(kept))
    for _ in range(20):  # the largest eigenvalue bounds the curvature
        u = np.bincount(slot, np.bincount(at, u[slot], n)[at], len(kept))
        size = float(np.linalg.norm(u))
        u /= size
    step = 1.0 / (0.25 * size / n + 1e-9)
    x = ahead = np.zeros(len(kept))
    for t in range(1, steps + 1):
        slope, by_cut = _likelihood(np.bincount(at, ahead[slot], n), cuts, grades)
        moved = ahead + step * np.bincount(slot, slope[at], len(kept)) / n
        new = np.sign(moved) * np.maximum(np.abs(moved) - step * shrink, 0.0)
        ahead = new + (t - 1) / (t + 2) * (new - x)
        x = new
        cuts = np.maximum.accumulate(cuts + 2.0 * by_cut / n)
    w[kept] = x
    return w, cuts


def graded_sample(docs: DataFrame, grades: DataFrame, most_labels: int) -> DataFrame:
    """Texts of at most ``most_labels`` graded documents (doc_id, grade), chosen by hash of their id.

    Where an id repeats in ``docs`` the text of the smallest hash stands for it, so rows are never more than the labels.
    """
    few = grades.where("grade is not null and doc_id is not null").orderBy(F.xxhash64("doc_id"), "grade").limit(most_labels)
    known = docs.select("doc_id", "text").join(F.broadcast(few), "doc_id")  # bounded by most_labels
    return known.groupBy("doc_id", "grade").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))


def _slots_of(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for t in batch.column(1):
                slots = {s for w in words_in(t.as_py()) for s in word_slots(w, bits)}
                found.append(np.array(sorted(slots), "<u4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int32()), pa.array(found, pa.binary())], ["grade", "slots"])

    return run


def train(docs: DataFrame, grades: DataFrame, bits: int = 20, grades_n: int = 3, most_labels: int = 16_000, least_texts: int = 3, **options) -> OrdinalModel:
    """A model of the grades 0 to ``grades_n`` - 1 from a bounded sample of labelled documents.

    Only the sample's slot numbers reach the driver. Slots met in fewer than ``least_texts`` sampled texts are left
    out. Without labels, or with one grade only, every text has the same expected severity.
    """
    rows = graded_sample(docs, grades, most_labels).select("grade", F.col("text").cast("string").alias("text"))
    rows = rows.mapInArrow(_slots_of(bits), "grade int, slots binary").toArrow()
    y = np.array(rows.column("grade").to_pylist(), np.int64)
    x = [np.frombuffer(b.as_buffer() or b"", "<u4") for b in rows.column("slots").combine_chunks()] if len(y) else []
    times = np.zeros(1 << bits, np.int64)
    for r in x:
        times[r] += 1
    number = np.full(1 << bits, -1, np.int64)
    often = np.flatnonzero(times >= least_texts)
    number[often] = np.arange(len(often))
    x = [(k := number[r])[k >= 0] for r in x]
    order = np.lexsort((np.array([len(r) for r in x], np.int64), y)) if len(y) else np.empty(0, np.int64)
    order = np.random.default_rng(5).permutation(order)
    fitted, held = order[: len(order) * 2 // 3], order[len(order) * 2 // 3 :]
    w, cuts = fit_ordinal([x[i] for i in fitted], y[fitted], len(often), grades_n, **options)
    least = best_cut(np.array([w[x[i]].sum() for i in held]), y[held] > 0, float(cuts[0]))
    keep = np.flatnonzero(np.abs(w) > 1e-3)
    return OrdinalModel({int(often[i]): float(w[i]) for i in keep}, [float(c) for c in cuts], bits, least)


def best_cut(scores: np.ndarray, toxic: np.ndarray, otherwise: float) -> float:
    """The score that parts ``toxic`` from the rest with the best F1; ``otherwise`` if none is toxic."""
    if not toxic.any():
        return otherwise
    order = np.argsort(-scores, kind="stable")
    f1 = 2 * np.cumsum(toxic[order]) / (np.arange(1, len(order) + 1) + toxic.sum())
    ends = np.append(scores[order][1:] < scores[order][:-1], True)  # equal scores fall on one side
    best = int(np.argmax(np.where(ends, f1, -1.0)))
    below = scores[order][best + 1] if best + 1 < len(order) else scores[order][best] - 1.0
    return float((scores[order][best] + below) / 2)


def _scorer(model: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: OrdinalModel = model.value
        known: dict[str, float] = {}
        for batch in batches:
            out = []
            for t in batch.column(1):
                if len(known) > 500_000:
                    known.clear()
                score = 0.0
                for w in words_in(t.as_py()):
                    got = known.get(w)
                    if got is None:
                        known[w] = got = m.word(w)
                    score += got
                over = m.over(score)
                p = np.diff([1.0, *over, 0.0]) * -1
                out.append((score, sum(over), int(np.argmax(p)), over[0]))
            columns = [pa.array(c, k) for c, k in zip(zip(*out), (pa.float64(), pa.float64(), pa.int32(), pa.float64()))] if out else []
            if columns:
                yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *columns], ["doc_id", "score", "severity", "grade", "p_toxic"])

    return run


def score(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """doc_id, ``score``, expected ``severity``, most likely ``grade``, ``p_toxic`` (any grade above 0) and ``toxic`` per row of ``docs``.

    Whole texts are read; a null text counts as empty and a null id stays null. No row leaves its task.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # at most one weight per hash slot
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = narrow.mapInArrow(_scorer(sent), "doc_id long, score double, severity double, grade int, p_toxic double")
    return out.withColumn("toxic", F.col("score") > model.least)


def label_grades(labels: DataFrame) -> DataFrame:
    """doc_id and grade of ``labels`` (doc_id, quality, toxic): 0 clean, 1 toxic, 2 toxic in a text of low quality too."""
    grade: Column = F.when(F.col("toxic") == 0, 0).when(F.col("toxic") == 1, F.when(F.col("quality") == 0, 2).otherwise(1))
    return labels.select(F.col("doc_id").cast("long").alias("doc_id"), grade.alias("grade"))
