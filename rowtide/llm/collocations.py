"""Phrase collocations counted over a prefix-free parse of the texts.

Words whose hash is divisible by a modulus trigger a cut, so texts that share a passage share its chunks wherever they begin.
Each chunk ends with the words of the next one that its last phrases reach into; only phrases that start before those are
counted in it, so every occurrence is counted once. Distinct chunks form the dictionary with their
frequencies, and phrases are counted inside distinct chunks only, weighted by these.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowtide.llm.tables import stored
from rowtide.llm.words import windows, word_hashes

MARK = b"."
_PLAIN = bytes.maketrans(b",;:!?\n\v\f\r\t", MARK * 9 + b" ")
#: One word in so many triggers a cut; without one a chunk is cut at ``LONGEST`` words and marks.
MODULUS, LONGEST = 16, 96
#: Chunks a task's dictionary holds before it hands them on.
MOST_HELD = 300_000
#: The broadcast filter of frequent phrases has so many bits (16 MB) whatever the input.
FILTER_BITS = 27
_BUCKET = 32_768  # bits of one row of Spark's bitmap aggregates
_SALTS = 64


def marked_words(text: bytes) -> bytes:
    """Words of a text, A-Z lower-cased, and a mark for every sign or line end that phrases may not cross; one space between."""
    return b" ".join(text.lower().translate(_PLAIN).replace(MARK, b" . ").split())


class _Powers:
    """Powers of an odd number and of its inverse modulo 2^64, as many as were ever needed at once."""

    base = 0x9E3779B97F4A7C15
    inverse = pow(base, -1, 1 << 64)

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if len(self.up) < n:
            factors = [np.full(2 * n, f, np.uint64) for f in (self.base, self.inverse)]
            for f in factors:
                f[0] = 1
            self.up, self.down = (np.multiply.accumulate(f) for f in factors)


_POWERS = _Powers()


def word_table(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and 64-bit hash of every word of a text with single spaces between words.

    A word's hash is a difference of prefix sums over the bytes, so all are had without a loop over words.
    """
    codes = np.frombuffer(data, np.uint8)
    spaces = np.flatnonzero(codes == 32)
    starts = np.concatenate([[0], spaces + 1])
    ends = np.concatenate([spaces, [len(codes)]])
    _POWERS.grow(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * _POWERS.up[: len(codes)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * _POWERS.down[starts]
    hashes ^= hashes >> np.uint64(32)
    hashes *= np.uint64(0xD6E8FEB86659FD93)
    hashes ^= hashes >> np.uint64(29)
    return starts, ends, hashes


def chunks(data: bytes, reach: int, modulus: int = MODULUS, longest: int = LONGEST) -> Iterator[tuple[bytes, int]]:
    """Overlapping chunks of marked words: text with ``reach`` words of what follows, and how many words are its own."""
    if not data:
        return
    starts, ends, hashes = word_table(data)
    triggers = np.flatnonzero(hashes % np.uint64(modulus) == 0).tolist()
    starts, ends, last = starts.tolist(), ends.tolist(), len(ends) - 1
    start = 0
    for end in [*triggers, last + 1]:
        while start < end:
            cut = min(end, start + longest)
            yield data[starts[start] : ends[min(cut + reach - 1, last)]], cut - start
            start = cut


def _binary(values: list) -> pa.Array:
    return pa.array(values, pa.binary())


def _parsed(reach: int, modulus: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                held.update([(lang, chunk, own) for chunk, own in chunks(marked_words(text.as_py()), reach, modulus)])
                if len(held) > MOST_HELD:
                    yield from _dictionary(held)
                    held.clear()
        yield from _dictionary(held)

    return run


def _dictionary(held: Counter) -> Iterator[pa.RecordBatch]:
    rows = list(held.items())
    for at in range(0, len(rows), 20_000):
        part = rows[at : at + 20_000]
        columns = [
            pa.array([k[0] for k, _ in part], pa.string()),
            _binary([k[1] for k, _ in part]),
            pa.array([k[2] for k, _ in part], pa.int32()),
            pa.array([n for _, n in part], pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "chunk", "own", "n"])


def dictionary(docs: DataFrame, reach: int = 2, modulus: int = MODULUS) -> DataFrame:
    """Distinct chunks of all texts: lang (null: ``und``), ``chunk``, ``own`` (words that start phrases here), ``n`` (its frequency); stored."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text")
    narrow = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text)
    parsed = narrow.mapInArrow(_parsed(reach, modulus), "lang string, chunk binary, own int, n long")
    return stored(parsed.groupBy("lang", "chunk", "own").agg(F.sum("n").alias("n")), "chunks")


# -- counting phrases inside distinct chunks ------------------------------------------------------


def _salt(lang: str) -> np.uint64:
    return word_hashes([lang.encode()])[0]


def slots(hashes: np.ndarray, salts: np.ndarray | np.uint64) -> np.ndarray:
    """Places in the filter of phrase hashes of a language."""
    return ((hashes ^ salts) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - FILTER_BITS)


def set_bits(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _phrases(size: int, filtered: Broadcast | None):
    """Phrases of ``size`` words of dictionary chunks with their weighted counts, combined for every batch; Spark combines these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if filtered is None else np.frombuffer(filtered.value, np.uint8)
        for batch in batches:
            if batch.num_rows:
                yield _counted(size, bits, *(batch.column(k).to_pylist() for k in range(4)))

    return run


def _counted(size: int, bits: np.ndarray | None, langs: list, texts: list, own: list, n: list) -> pa.RecordBatch:
    data = b" . ".join(texts)
    starts, ends, hashes = word_table(data)
    lengths = np.array([t.count(b" ") + 2 for t in texts])  # with the mark between two chunks
    lengths[-1] -= 1
    firsts = np.cumsum(lengths) - lengths
    of = np.repeat(np.arange(len(texts)), lengths)
    known = {lang: _salt(lang) for lang in set(langs)}
    salts = np.array([known[lang] for lang in langs], np.uint64)[of]
    places = max(0, len(hashes) - size + 1)
    is_word = (ends - starts != 1) | (np.frombuffer(data, np.uint8)[starts] != MARK[0])
    fits = (np.arange(len(of)) - firsts[of] < np.array(own)[of])[:places]
    for k in range(size):
        fits = fits & is_word[k : k + places]
    if bits is not None:
        shorter = windows(hashes, size - 1)
        frequent = set_bits(bits, slots(shorter, salts[: len(shorter)]))
        fits &= frequent[:places] & frequent[1 : places + 1]
    at = np.flatnonzero(fits)
    keys = (windows(hashes, size)[at] ^ salts[at]) * np.uint64(0xBF58476D1CE4E5B9)
    order = np.argsort(keys)
    keys, at = keys[order], at[order]
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    counts = np.add.reduceat(np.array(n, np.int64)[of[at]], new) if len(keys) else np.empty(0, np.int64)
    at = at[new]
    phrases = [data[s:e] for s, e in zip(starts[at].tolist(), ends[at + size - 1].tolist())]
    columns = [pa.array(langs, pa.string()).take(pa.array(of[at])), _binary(phrases), pa.array(counts)]
    return pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "n"])


def _slots_of(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            langs = batch.column(0).to_pylist()
            known = {lang: _salt(lang) for lang in set(langs)}
            hashes = word_table(b" ".join(batch.column(1).to_pylist()))[2]
            at = slots(windows(hashes, size)[::size], np.array([known[lang] for lang in langs], np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64))], ["slot"])

    return run


def frequent_filter(phrases: DataFrame, size: int) -> Broadcast:
    """Bits of the ``phrases`` (lang, phrase) of ``size`` words, broadcast: 2^27 bits for any input.

    A phrase whose bit is not set is not among them, so longer phrases that hold it are never frequent. Where the bits fill
    up fewer are spared; counts stay the same.
    """
    slot = phrases.select("lang", "phrase").mapInArrow(_slots_of(size), "slot long")
    rows = slot.groupBy(F.bitmap_bucket_number(F.col("slot") + 1).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("slot") + 1)).alias("bits"))
    bits = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    width = _BUCKET // 8
    for row in rows.toLocalIterator():  # at most 4096 rows of 4 KB
        at = (row["bucket"] - 1) * width
        bits[at : at + width] = np.frombuffer(row["bits"], np.uint8)
    return phrases.sparkSession.sparkContext.broadcast(bits.tobytes())


def phrase_counts(chunked: DataFrame, most_words: int, least: int) -> tuple[DataFrame, DataFrame]:
    """Counts of phrases of 1 to ``most_words`` words that occur ``least`` times or more (lang, phrase, size, f), and of all words (lang, n).

    Phrases of each size are counted only where both their ends, one word shorter, may be frequent.
    """
    words = stored(chunked.mapInArrow(_phrases(1, None), "lang string, phrase binary, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("f")), "words")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    found = words.where(F.col("f") >= least)
    out = found.select("lang", "phrase", F.lit(1).alias("size"), "f")
    for size in range(2, most_words + 1):
        counts = chunked.mapInArrow(_phrases(size, frequent_filter(found, size - 1)), "lang string, phrase binary, n long")
        found = stored(counts.groupBy("lang", "phrase").agg(F.sum("n").alias("f")).where(F.col("f") >= least), "phrases")
        out = out.unionByName(found.select("lang", "phrase", F.lit(size).alias("size"), "f"))
    return out.withColumn("phrase", F.col("phrase").cast("string")), totals


# -- scores ---------------------------------------------------------------------------------------


def _joined(words: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def _exact(count: str) -> Column:
    return F.col(count).cast("decimal(16,0)")


def exact_score() -> Column:
    """floor(1000000 * a * a / (l * r)) in whole decimals of 38 digits."""
    top = F.lit(1_000_000).cast("decimal(7,0)") * (_exact("a") * _exact("a"))
    return F.call_function("div", top, _exact("l") * _exact("r")).cast("long")


def scored(counts: DataFrame) -> DataFrame:
    """Every phrase of two or more words with its lowest-scoring cut: lang, phrase, size, a, l, r, score."""
    words = F.split("phrase", " ", -1)
    longer = counts.where("size > 1").withColumnRenamed("f", "a")
    cuts = longer.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.withColumns({"left": _joined(words, F.lit(1), F.col("k")), "right": _joined(words, F.col("k") + 1, F.col("size") - F.col("k"))})
    # a part occurs at least as often as the whole, so it is among the counts
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    best = F.min(F.struct(exact_score().alias("score"), "k", "l", "r")).alias("_cut")
    return cuts.groupBy("lang", "phrase", "size", "a").agg(best).select("lang", "phrase", "size", "a", "_cut.l", "_cut.r", "_cut.score")


def _swallowed(counts: DataFrame, most_words: int) -> DataFrame:
    """The highest count ``longest_f`` of any longer phrase that holds a phrase (lang, phrase)."""
    words = F.split("phrase", " ", -1)
    parts = []
    for size in range(2, most_words):
        places = F.sequence(F.lit(1), F.col("size") - size + 1)
        held = counts.where(F.col("size") > size).select("lang", "f", words.alias("_w"), F.explode(places).alias("_i"))
        parts.append(held.select("lang", _joined(F.col("_w"), F.col("_i"), F.lit(size)).alias("phrase"), "f"))
    inside = parts[0]
    for part in parts[1:]:
        inside = inside.unionByName(part)
    return inside.groupBy("lang", "phrase").agg(F.max("f").alias("longest_f"))


def _first_per_lang(rows: DataFrame, most: int) -> DataFrame:
    """The first ``most`` rows of each language with their ``rank``; first within salted parts, so no task sorts a whole language."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(_SALTS)))
    near = salted.withColumn("_rn", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*order))).where(F.col("_rn") <= most)
    ranks = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranks.where(F.col("rank") <= most).drop("_salt", "_rn")


def collocations(
    docs: DataFrame, most_words: int = 3, least: int = 10, swallow_percent: int = 50, most: int = 2000, modulus: int = MODULUS
) -> DataFrame:
    """Each language's first ``most`` phrases of 2 to ``most_words`` words by how much more often they occur than their parts.

    Texts (null: empty) are lower-cased (A-Z) and cut at ``.,;:!?`` and line ends; phrases of space- or tab-separated words don't cross cuts.
    Phrases that occur ``least`` times or more are scored by their weakest cut, 1000000 * a * a / (l * r) rounded down (ties: the
    first cut); one is left out when a longer such phrase that holds it has ``swallow_percent`` of its count or more.
    Columns: lang (null: ``und``), rank, phrase, a, l, r, n (the language's words), score. Ordered by score and a descending, then phrase by
    bytes. Repeated rows count each time; other columns are ignored; an empty table gives no rows.
    """
    if most_words < 2:
        raise ValueError("phrases have two words or more")
    counts, totals = phrase_counts(dictionary(docs, most_words - 1, modulus), most_words, least)
    rows = stored(scored(counts), "scored")
    if most_words > 2:
        inside = _swallowed(counts, most_words)
        rows = rows.join(inside, ["lang", "phrase"], "left")
        kept = F.col("longest_f").isNull() | (F.col("longest_f") * 100 < F.col("a") * swallow_percent)
        rows = rows.where(kept).drop("longest_f")
    first = _first_per_lang(rows, most).join(totals, "lang")
    return first.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
