"""Packing tokenised documents into sequences with a fixed number of open windows per partition."""

from __future__ import annotations

import os
import unicodedata
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from struct import pack as struct_pack

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.tables import stored

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, window long, offset long, open boolean, ids binary"
#: Words whose ids a worker remembers in each of two generations.
MOST_WORDS = 300_000
#: Marks that stand apart from the letters before them.
MARKS = ".,;:!?|#*$%&"


class WordIds(dict):
    """Ids of white-space separated words as little-endian bytes, found as words are met.

    The tokenizer drops white space and never joins across it, so a text's ids are those of its words in turn.
    A word of letters is one unit of the tokenizer, and marks behind its last letter are another, so both are
    looked up as words of their own. Words of small letters go straight to the tokenizer's merges, which spares the
    passes over white space and patterns that can't change them; all others take the whole tokenizer.

    What is remembered does not grow with the input: beyond ``MOST_WORDS`` a new generation begins and the one before the
    last is forgotten, so words that come again stay and those met once go.
    """

    def __init__(self, path: str):
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model.tokenize
        self.older: dict[bytes, bytes] = {}

    def __missing__(self, word: bytes) -> bytes:
        found = self.older.get(word)
        if found is None:
            if word.isalpha() and word.islower():  # of bytes: ASCII letters only
                ids = [t.id for t in self.merges(word.decode())]
                found = struct_pack(f"<{len(ids)}I", *ids)
            else:
                found = self._found(word)
        self[word] = found
        return found

    def _found(self, word: bytes) -> bytes:
        core = word.rstrip(_MARKS)
        if core.isalpha():
            return self[core.lower()] + self[word[len(core) :]] if len(core) < len(word) else self[core.lower()]
        text = word.decode()
        units = _units(text)
        if units != (text,):
            return b"".join([self[u.encode()] for u in units])
        if text.isalpha() and text.islower() and unicodedata.is_normalized("NFC", text):
            ids = [t.id for t in self.merges(word.decode("latin-1").translate(_BYTE_CHARS))]
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct_pack(f"<{len(ids)}I", *ids)

    def learn(self, texts: list[list[bytes]]) -> None:
        for words in texts:
            self.ids(words)

    def ids(self, words: list[bytes]) -> bytes:
        if len(self) > MOST_WORDS:
            self.older = dict(self)
            self.clear()
        return b"".join(map(self.__getitem__, words))


def _byte_chars() -> dict[int, int]:
    """The characters that byte-level merges use for bytes: printable ones stand for themselves, the rest from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in plain]
    return {b: 256 + i for i, b in enumerate(rest)}


_BYTE_CHARS = _byte_chars()
_MARKS = MARKS.encode()


def _units(word: str) -> tuple[str, ...]:
    core = word.rstrip(MARKS)
    if not core.isalpha() or "\u03a3" in core:  # the capital sigma's lower case depends on its place
        return (word,)
    low = unicodedata.normalize("NFC", core).lower()
    if not low.isalpha():  # a mark that the tokenizer's own lower case or composition leaves would join what follows
        return (word,)
    return (low, word[len(core) :]) if len(core) < len(word) else (low,)


_WORDS: dict[str, WordIds] = {}


class Windows:
    """At most ``most`` open windows of ``room`` tokens; an item goes where it leaves least room."""

    def __init__(self, room: int, most: int):
        self.room, self.most = room, most
        self.gaps: list[tuple[int, int]] = []  # (free tokens, window number), ascending
        self.items: dict[int, list] = {}
        self.next = 0

    def put(self, length: int, item) -> list | None:
        """Place an item; a window closed by that is returned as (number, items with offsets)."""
        closed = None
        at = bisect_left(self.gaps, (length, -1))
        if at < len(self.gaps):
            gap, number = self.gaps.pop(at)
        else:
            if len(self.gaps) >= self.most:
                closed = self.close(0)  # the fullest
            gap, number = self.room, self.next
            self.next += 1
            self.items[number] = []
        self.items[number].append((self.room - gap, item))
        if gap > length:
            insort(self.gaps, (gap - length, number))
        else:
            full = (number, self.items.pop(number))
            return [full] if closed is None else [closed, full]
        return None if closed is None else [closed]

    def close(self, at: int):
        _, number = self.gaps.pop(at)
        return number, self.items.pop(number)

    def rest(self) -> Iterator:
        while self.gaps:
            yield self.close(0)


def _pack_texts(path: str, end_id: int, room: int, most: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _WORDS[path] if path in _WORDS else _WORDS.setdefault(path, WordIds(path))
        base = TaskContext.get().partitionId() << 32
        open_windows = Windows(room, most)
        rows: list[tuple] = []

        def emit(window, is_open: bool) -> None:
            number, items = window
            rows.extend((*piece[:5], base + number, offset, is_open, piece[5]) for offset, piece in items)

        for batch in _cut(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                ids = words.ids((text or b"").split()) + end_id.to_bytes(4, "little")
                total = len(ids) // 4
                for start in range(0, total, room):
                    part = ids[4 * start : 4 * (start + room)]
                    piece = (doc_id, start, len(part) // 4, zlib.crc32(part), total, part if with_ids else None)
                    for window in open_windows.put(len(part) // 4, piece) or ():
                        emit(window, False)
                if len(rows) >= 20_000:
                    yield _batch(rows)
                    rows.clear()
        for window in open_windows.rest():
            emit(window, True)
        if rows:
            yield _batch(rows)

    return run


def _cut(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(),) * 7 + (pa.bool_(), pa.binary())
    names = [c.split()[0] for c in PIECES.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)


def _merge(room: int, most: int):
    """Packs whole windows (number, fill) into new ones: number, ``new``, ``shift``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = (1 << 62) + (TaskContext.get().partitionId() << 32)
        open_windows = Windows(room, most)
        for batch in batches:
            rows: list[tuple] = []
            for number, fill in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for new, items in open_windows.put(fill, number) or ():
                    rows.extend((item, base + new, shift) for shift, item in items)
            if rows:
                yield _merged(rows)
        rows = [(item, base + new, shift) for new, items in open_windows.rest() for shift, item in items]
        if rows:
            yield _merged(rows)

    return run


def _merged(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["window", "new", "shift"])


def pack(
    docs: DataFrame, tokenizer: str, end_id: int = 2, room: int = 4096, most_open: int = 64, windows_per_merge: int = 4096, with_ids: bool = False
) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text) and the sequences they lie in, at most ``room`` tokens each.

    One row per piece: doc_id, ``start`` (its document's ids before it), ``length``, ``ids_crc32`` of the ids as
    little-endian unsigned 32-bit, ``doc_tokens``, ``sequence_id``, ``offset``; ``ids`` (the same bytes) if ``with_ids``.
    A document is cut only where it is longer than a sequence. Each task packs as its rows come, holding
    ``most_open`` windows: a piece goes where it leaves least room; when none fits and all are open, the fullest is
    emitted. Windows still open at a task's end are merged the same way, about ``windows_per_merge`` per
    task. A null text counts as empty (its end id alone), a null doc_id stays null, and rows repeating an id
    are packed each for itself. Other columns are ignored; an empty table gives no rows.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = stored(narrow.mapInArrow(_pack_texts(tokenizer, end_id, room, most_open, with_ids), PIECES), "pieces")
    ended = pieces.where("open").groupBy("window").agg(F.sum("length").alias("fill"))
    ended = stored(ended, "ended")
    tasks = max(1, ended.count() // windows_per_merge)
    dealt = ended.repartition(tasks, F.xxhash64("window")).sortWithinPartitions(F.desc("fill"), "window")
    merged = stored(dealt.mapInArrow(_merge(room, most_open), "window long, new long, shift long"), "merged")
    kept = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    last = ["ids"] if with_ids else []
    done = pieces.where("not open").select(*kept, F.col("window").alias("sequence_id"), "offset", *last)
    moved = pieces.where("open").join(merged, "window")
    moved = moved.select(*kept, F.col("new").alias("sequence_id"), (F.col("offset") + F.col("shift")).alias("offset"), *last)
    return done.unionByName(moved)
