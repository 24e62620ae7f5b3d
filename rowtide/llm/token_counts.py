"""Tokens per text by a two-tier lookup inside the tasks: a broadcast table of frequent pre-tokens, then worker caches."""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.tables import stored

#: Pre-tokens of the broadcast table; their text is at most ``LONGEST`` characters each, so the table has a size bound.
MOST_FREQUENT, LONGEST = 32_768, 64
#: Pre-tokens a worker remembers besides.
MOST_CACHED = 400_000
#: Summaries that are merged into one at a time, and that may reach the driver.
FAN_IN = 16

_SPACE = "▁"  # the library's own sign for a space
_RUNS = re.compile(" +[^ ]*")
_PROBE = "a  b c  d　e ﬁ x\n y\t z ▁▁q <s> </s> \U0001f600 é \x00 <0x41>  "


def pretokens(text: str) -> list[str]:
    """The parts of a text that are encoded apart: each run of spaces with what follows it, less one space.

    The tokenizer puts a space before the text and its pieces hold spaces at their start only, so no piece
    crosses the end of a part. A single space alone is the empty part.
    """
    if not text:
        return []
    if _SPACE in text:
        text = text.replace(_SPACE, " ")
    if "  " not in text and text[0] != " " and text[-1] != " ":
        return text.split(" ")
    return [part[1:] for part in _RUNS.findall(" " + text)]


class Encoder:
    """Numbers of tokens from the library itself."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        self.lone_space = self.whole("a ") - self.whole("a")

    def whole(self, text: str) -> int:
        return len(self.model.encode(text))

    def lengths(self, parts: list[str]) -> list[int]:
        """Tokens of every part; the empty part stands for a single space."""
        found = [len(ids) for ids in self.model.encode(parts, num_threads=1)] if parts else []
        return [n if part else self.lone_space for n, part in zip(found, parts)]

    def parts_suffice(self) -> bool:
        """Whether texts may be cut by :func:`pretokens`: spaces only lead pieces, and nothing else is taken for one."""
        model = self.model
        if any(_SPACE in model.id_to_piece(i).lstrip(_SPACE) for i in range(model.get_piece_size())):
            return False
        probes = (_PROBE, " " + _PROBE.strip(), "a", " ", "  ", "a ")
        return all(sum(self.lengths(pretokens(t))) == self.whole(t) for t in probes)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    return _ENCODERS[path] if path in _ENCODERS else _ENCODERS.setdefault(path, Encoder(path))


class Lengths(dict):
    """Second tier: lengths a worker has found, forgotten all at once when they are too many."""

    def __init__(self, path: str, most: int = MOST_CACHED):
        super().__init__()
        self.path, self.most = path, most

    def learn(self, parts: list[str]) -> dict[str, int]:
        """Lengths of parts in neither tier; long parts are not remembered."""
        found = dict(zip(parts, encoder(self.path).lengths(parts)))
        short = {p: n for p, n in found.items() if len(p) <= LONGEST}
        if len(self) + len(short) > self.most:
            self.clear()
        self.update(short)
        return found


# -- first tier: what is frequent, over all texts -------------------------------------------------


def _top(counts: Counter, most: int) -> list[tuple[str, int]]:
    return sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:most]


def _summary(counts: Counter, most: int) -> pa.RecordBatch:
    top = _top(counts, most)
    columns = [pa.array([[k for k, _ in top]], pa.list_(pa.string())), pa.array([[n for _, n in top]], pa.list_(pa.int64()))]
    return pa.RecordBatch.from_arrays(columns, ["parts", "counts"])


def _frequent_in_task(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                counts.update([p for p in pretokens(text.as_py()) if len(p) <= LONGEST])
                if len(counts) > 8 * most:
                    counts = Counter(dict(_top(counts, most)))
        if counts:
            yield _summary(counts, most)

    return run


def _merged(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for parts, ns in zip(batch.column(0), batch.column(1)):
                counts.update(dict(zip(parts.as_py(), ns.as_py())))
                if len(counts) > 8 * most:
                    counts = Counter(dict(_top(counts, most)))
        if counts:
            yield _summary(counts, most)

    return run


def frequent_pretokens(texts: DataFrame, most: int = MOST_FREQUENT) -> list[str]:
    """About the ``most`` frequent pre-tokens of all texts (column ``text``, no nulls).

    Every task sends one summary of bounded size; summaries are merged ``FAN_IN`` at a time, task by task and without a
    shuffle, until few enough are left for the driver. What a summary leaves out costs time later, never a result.
    """
    summaries = stored(texts.select("text").mapInArrow(_frequent_in_task(most), "parts array<string>, counts array<long>"), "frequent")
    n = summaries.count()
    while n > FAN_IN:
        merged = summaries.coalesce(-(-n // FAN_IN)).mapInArrow(_merged(most), "parts array<string>, counts array<long>")
        summaries = stored(merged, "frequent")
        fewer = summaries.count()
        if fewer >= n:  # files that Spark reads by themselves
            break
        n = fewer
    counts: Counter = Counter()
    for row in summaries.toLocalIterator():
        counts.update(dict(zip(row["parts"], row["counts"])))
        counts = Counter(dict(_top(counts, most)))
    return [k for k, _ in _top(counts, most)]


class FrequentTable:
    """First tier in compact form: one string, the parts' ends in it, and their lengths in tokens."""

    def __init__(self, parts: list[str], lengths: list[int]):
        self.text = "".join(parts)
        self.ends = np.cumsum([len(p) for p in parts], dtype=np.int32)
        self.lengths = np.array(lengths, np.int32)

    def table(self) -> dict[str, int]:
        starts = [0, *self.ends[:-1].tolist()]
        return {self.text[a:b]: n for a, b, n in zip(starts, self.ends.tolist(), self.lengths.tolist())}


_FIRST: dict[str, dict[str, int]] = {}
_SECOND: dict[str, Lengths] = {}


def _counted(path: str, frequent: Broadcast | None):
    table = uuid.uuid4().hex  # a worker keeps one table, that of the job it serves

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if frequent is None:
            whole = encoder(path).whole
            for batch in batches:
                counts = [whole(t.as_py()) for t in batch.column(2)]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])
            return
        if table not in _FIRST:
            _FIRST.clear()
            _FIRST[table] = frequent.value.table()
        first = _FIRST[table]
        second = _SECOND[path] if path in _SECOND else _SECOND.setdefault(path, Lengths(path))
        for batch in batches:
            counts = []
            for text in batch.column(2):
                parts = pretokens(text.as_py())
                found = list(map(first.get, parts))
                total = 0
                if None in found:
                    rest = [p for p, n in zip(parts, found) if n is None]
                    lengths = {p: second.get(p) for p in rest}
                    new = [p for p, n in lengths.items() if n is None]
                    if new:
                        lengths |= second.learn(new)
                    total = sum(map(lengths.__getitem__, rest))
                    found = [n for n in found if n is not None]
                counts.append(total + sum(found))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    return run


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 4096, most_frequent: int = MOST_FREQUENT) -> DataFrame:
    """Tokens of every whole text of ``docs`` (doc_id, text): doc_id, ``n_bytes``, ``n_tokens``, ``over_limit``.

    ``tokenizer`` is the path of a sentencepiece model; counts are those of its ``encode``, without begin and end. A
    task looks each pre-token up in the broadcast table, then in its worker's cache, and encodes what is in neither; no
    pre-token leaves its task. Models whose pieces may cross spaces encode every text whole instead.
    A null text counts as empty and an empty one has 0 tokens; a null doc_id stays null and rows repeating an id are
    counted each for itself. Other columns are ignored; an empty table gives no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    frequent = None
    if encoder(tokenizer).parts_suffice():
        parts = frequent_pretokens(narrow, most_frequent)
        frequent = docs.sparkSession.sparkContext.broadcast(FrequentTable(parts, encoder(tokenizer).lengths(parts)))
    counted = narrow.mapInArrow(_counted(tokenizer, frequent), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
