"""Quality rules: text statistics and decision lists learned by sequential covering."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.words import windows, word_hashes

SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_upper", "n_digits", "n_marks", "n_long")
#: What rules may test; the counts above as shares, so that a rule means the same for short and long texts.
RATIOS = ("mean_word", "symbol_share", "dup_line_share", "repeat_share", "distinct_share", "upper_share", "digit_share", "mark_share", "words_per_line", "long_share")
_FIELDS = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)


def text_counts(text: str | None) -> tuple[int, ...]:
    """The counts of one text in the order of ``COUNTS``; all 0 for null or empty."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    if not n:
        return (0, 0, sum(map(text.count, SYMBOLS))) + (0,) * (len(COUNTS) - 3)
    chars = len(text) - sum(map(raw.count, (b" ", b"\t", b"\n", b"\v", b"\f", b"\r")))
    hashes = word_hashes(words)
    runs = windows(hashes, 5)
    repeated = 0
    if len(runs):
        _, where, times = np.unique(runs, return_inverse=True, return_counts=True)
        starts = np.flatnonzero(times[where] > 1)
        if len(starts):
            edges = np.zeros(n + 1, np.int32)
            edges[starts] += 1
            edges[starts + 5] -= 1
            repeated = int(np.count_nonzero(np.cumsum(edges)))
    seen: set[bytes] = set()
    again = n_lines = 0
    for line in raw.split(b"\n"):
        if line and not line.isspace():
            n_lines += 1
            if line in seen:
                again += 1
            seen.add(line)
    codes = np.frombuffer(raw, np.uint8)
    kinds = np.bincount(_KIND[codes], minlength=4)
    lengths = np.fromiter(map(len, words), np.int32, n)
    distinct = len(np.unique(hashes))
    return (n, chars, sum(map(text.count, SYMBOLS)), again, repeated, n_lines, distinct, int(kinds[1]), int(kinds[2]), int(kinds[3]), int((lengths > 15).sum()))


_KIND = np.zeros(256, np.uint8)
_KIND[65:91], _KIND[48:58] = 1, 2
_KIND[[ord(c) for c in ".,;:!?"]] = 3


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", *COUNTS]
    for batch in batches:
        columns = [batch.column(0).cast(pa.int64())]
        rows = [text_counts(t.as_py()) for t in batch.column(1)]
        columns += [pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64()) for _ in COUNTS]
        yield pa.RecordBatch.from_arrays(columns, names)


def text_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and ``COUNTS`` of every whole text (null: none), one row per row of ``docs``; no shuffle."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(_counts, _FIELDS)


def base_failed() -> Column:
    """Fewer than ten words, or more than a fifth of them in repeated windows."""
    return (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)


def ratios() -> dict[str, Column]:
    """``RATIOS`` as expressions over ``COUNTS``; 0 where there is nothing to divide by."""

    def share(a: str, b: str) -> Column:
        return F.coalesce(F.col(a) / F.nullif(F.col(b).cast("double"), F.lit(0.0)), F.lit(0.0))

    return {
        "mean_word": share("word_chars", "n_words"),
        "symbol_share": share("n_symbols", "word_chars"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "distinct_share": share("n_distinct", "n_words"),
        "upper_share": share("n_upper", "word_chars"),
        "digit_share": share("n_digits", "word_chars"),
        "mark_share": share("n_marks", "n_words"),
        "words_per_line": share("n_words", "n_lines"),
        "long_share": share("n_long", "n_words"),
    }


@dataclass(frozen=True)
class Rule:
    """A conjunction of tests (column, '<=' or '>', threshold) and the verdict where all hold."""

    tests: tuple[tuple[str, str, float], ...]
    reject: bool = True

    def column(self) -> Column:
        found = F.lit(True)
        for name, sign, cut in self.tests:
            found = found & (F.col(name) <= cut if sign == "<=" else F.col(name) > cut)
        return found

    def covers(self, x: np.ndarray, names: tuple[str, ...]) -> np.ndarray:
        found = np.ones(len(x), bool)
        for name, sign, cut in self.tests:
            values = x[:, names.index(name)]
            found &= values <= cut if sign == "<=" else values > cut
        return found

    def __str__(self) -> str:
        return " and ".join(f"{n} {s} {c:.6g}" for n, s, c in self.tests)


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    return p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0))) if p else -1.0


def _grow(x: np.ndarray, bad: np.ndarray, names: tuple[str, ...], most_tests: int) -> tuple:
    """Add the test of largest information gain until no good row is covered."""
    tests, inside = [], np.ones(len(x), bool)
    while len(tests) < most_tests and (~bad[inside]).any():
        p0, n0 = int(bad[inside].sum()), int((~bad[inside]).sum())
        best = (1e-9, None)
        for j, name in enumerate(names):
            values, y = x[inside, j], bad[inside]
            order = np.argsort(values, kind="stable")
            v, up = values[order], np.cumsum(y[order])
            cuts = np.flatnonzero(v[1:] > v[:-1])
            if len(cuts) > 64:
                cuts = cuts[np.linspace(0, len(cuts) - 1, 64).astype(int)]
            for at in cuts:
                low_p, low = int(up[at]), int(at) + 1
                cut = float((v[at] + v[at + 1]) / 2)
                for sign, p, n in (("<=", low_p, low - low_p), (">", p0 - low_p, n0 - (low - low_p))):
                    g = _gain(p, n, p0, n0)
                    if g > best[0]:
                        best = (g, (name, sign, cut))
        if best[1] is None:
            break
        tests.append(best[1])
        inside &= Rule((best[1],)).covers(x, names)
    return tuple(tests)


def _worth(tests: tuple, x: np.ndarray, bad: np.ndarray, names) -> tuple[float, int, int]:
    found = Rule(tests).covers(x, names)
    p, n = int(bad[found].sum()), int((~bad[found]).sum())
    return ((p - n) / (p + n) if p + n else -1.0), p, n


def learn_rules(
    x: np.ndarray, bad: np.ndarray, names: tuple[str, ...], least_precision: float = 0.9, least_rows: int = 3, most_rules: int = 12, most_tests: int = 4, seed: int = 7
) -> list[Rule]:
    """Ordered rejecting rules: each grown on two thirds of what is left, pruned on the last third, kept if precise there.

    A rule is taken when at least ``least_precision`` of the held-out rows it covers are bad; covering then goes on without
    the rows it covers. What no rule covers is kept. No bad or no good rows give no rules.
    """
    rules: list[Rule] = []
    left = np.ones(len(x), bool)
    random = np.random.default_rng(seed)
    misses = 0
    while len(rules) < most_rules and misses < 3 and bad[left].sum() >= least_rows and (~bad[left]).any():
        rows = np.flatnonzero(left)
        random.shuffle(rows)
        cut = len(rows) * 2 // 3
        grow, prune = rows[:cut], rows[cut:]
        tests = _grow(x[grow], bad[grow], names, most_tests)
        best = max((tests[:k] for k in range(1, len(tests) + 1)), key=lambda t: (_worth(t, x[prune], bad[prune], names)[0], -len(t)), default=())
        _, p, n = _worth(best, x[prune], bad[prune], names) if best else (0, 0, 0)
        if not best or p < least_rows or p < least_precision * (p + n):
            misses += 1
            continue
        rules.append(Rule(best))
        left &= ~rules[-1].covers(x, names)
    return rules


def labelled_sample(labels: DataFrame, most_labels: int) -> DataFrame:
    """doc_id and quality of at most ``most_labels`` rows of ``labels`` (doc_id, quality 0 or 1), chosen by hash of their id."""
    marked = labels.where("quality in (0, 1) and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
    return marked.orderBy(F.xxhash64("doc_id"), "quality").limit(most_labels)


def rules_from_labels(statistics: DataFrame, sample: DataFrame, **options) -> list[Rule]:
    """Rules from a bounded ``sample`` of labels and the ``statistics`` of their documents.

    Rows that fail the base rule are not learned from: the list only judges the others. Of documents that share an id the one
    with the least statistics stands for it, so no more rows than labels reach the driver.
    """
    rows = statistics.where(~base_failed()).join(F.broadcast(sample), "doc_id")  # bounded by the sample
    shares = F.struct(*[c.alias(k) for k, c in ratios().items()])
    rows = rows.groupBy("doc_id", "quality").agg(F.min(shares).alias("_r")).select("doc_id", "quality", "_r.*")
    rows = rows.orderBy("doc_id", "quality", *RATIOS).toPandas()
    if not len(rows):
        return []
    return learn_rules(rows[list(RATIOS)].to_numpy(float), rows["quality"].to_numpy() == 0, RATIOS, **options)


def verdict_column(rules: list[Rule]) -> Column:
    """The decision list as an ordered conditional over ``RATIOS``; true where the text stays."""
    verdict = F.lit(True)
    for rule in reversed(rules):
        verdict = F.when(rule.column(), F.lit(not rule.reject)).otherwise(verdict)
    return verdict


def judge(statistics: DataFrame, rules: list[Rule]) -> DataFrame:
    """``statistics`` with ``RATIOS``, ``base_failed``, ``rule`` (number of the first that fired, from 1) and ``kept``."""
    fired = F.lit(None).cast("int")
    for i, rule in reversed(list(enumerate(rules, 1))):
        fired = F.when(rule.column(), F.lit(i)).otherwise(fired)
    rows = statistics.withColumns(ratios()).withColumn("base_failed", base_failed())
    return rows.withColumns({"rule": fired, "kept": ~F.col("base_failed") & verdict_column(rules)})


def keep_good(docs: DataFrame, labels: DataFrame, most_labels: int = 20_000) -> DataFrame:
    """``docs`` without the documents that the base rule or the learned rules reject; all columns stay.

    The statistics are taken along with the rows, so nothing is joined back; every row is judged by its own text.
    """
    sample = labelled_sample(labels, most_labels)
    known = docs.join(F.broadcast(sample), "doc_id", "left_semi")  # bounded by most_labels
    rules = rules_from_labels(text_statistics(known), sample)
    counts = F.pandas_udf(_count_frame, ", ".join(f"{c} long" for c in COUNTS))
    rows = docs.select(F.struct(*docs.columns).alias("_row"), counts(F.col("text")).alias("_c"))
    return judge(rows.select("_row", "_c.*"), rules).where("kept").select("_row.*")


def _count_frame(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([text_counts(t) for t in texts], columns=list(COUNTS))
