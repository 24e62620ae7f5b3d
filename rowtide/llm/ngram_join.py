"""Jaccard self-join of documents on word shingles, filtered by prefixes under several token orders."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.components import components
from rowtide.llm.tables import stored
from rowtide.llm.words import shingle_set
from rowtide.session import broadcast_if_small, shuffle_width

WIDTH = 5
#: Similarity of linked documents in hundredths.
LEAST = 80
#: Buckets and chunks of the frequency table: fixed, whatever the input.
BITS, CHUNKS = 20, 256
#: Multipliers that shuffle tokens of one frequency class, one per order. The first order makes the index.
ORDERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)


def set_id(tokens: np.ndarray) -> int:
    """Signed 64-bit digest of a shingle set: documents of equal sets are one class."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes())).astype(np.int64))


def prefix_length(n: int) -> int:
    """Linked sets share a token among so many first ones of either, in any common order."""
    return n - (LEAST * n + 99) // 100 + 1


def prefix(tokens: np.ndarray, classes: np.ndarray, order: int) -> np.ndarray:
    """The first tokens of a set in an order: rarer frequency classes first, then by a hash of the order's own."""
    mixed = tokens * np.uint64(ORDERS[order])
    mixed ^= mixed >> np.uint64(32)
    key = (classes[tokens >> np.uint64(64 - BITS)].astype(np.uint64) << np.uint64(56)) | (mixed >> np.uint64(8))
    return tokens[np.argsort(key, kind="stable")[: prefix_length(len(tokens))]]


def parity(tokens: np.ndarray) -> bytes:
    """A bit per bucket of hashes: whether it holds an odd number of the set's tokens. About as many bits as tokens, at least 64."""
    size = max(6, int(len(tokens) - 1).bit_length())
    counts = np.bincount((tokens >> np.uint64(64 - size)).astype(np.int64), minlength=1 << size)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def may_link(n: int, bits: bytes, m: int, others: bytes) -> bool:
    """False only where two sets of ``n`` and ``m`` tokens differ in too many to be linked.

    Every bucket of unequal parity holds a token that one set alone has, and linked sets differ in a ninth of their sizes' sum
    at most. The longer bits are folded to the length of the shorter: neighbouring buckets become one.
    """
    x, y = (np.unpackbits(np.frombuffer(b, np.uint8)) for b in (bits, others))
    while len(x) > len(y):
        x = x[::2] ^ x[1::2]
    while len(y) > len(x):
        y = y[::2] ^ y[1::2]
    return int(np.count_nonzero(x != y)) * (100 + LEAST) <= (100 - LEAST) * (n + m)


def _near_enough(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(a, b) for a, b, n, x, m, y in zip(*(c.to_pylist() for c in batch.columns)) if may_link(n, x, m, y)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["a", "b"])


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "key", "n", "cid", "bits", "chunk", "counts"]
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.binary())
    counts = np.zeros(1 << BITS, np.int32)
    for batch in batches:
        rows = []
        for doc_id, text, key in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
            tokens = shingle_set(text.as_py(), WIDTH)
            slots = tokens >> np.uint64(64 - BITS)  # ascending, as the tokens are
            if len(slots):
                np.add.at(counts, slots.astype(np.int64), 1)
            rows.append((doc_id, key, len(tokens), set_id(tokens), parity(tokens) if len(tokens) else None, None, None))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
    parts = counts.reshape(CHUNKS, -1)
    rows = [(None, None, None, None, None, i, parts[i].tobytes()) for i in range(CHUNKS) if parts[i].any()]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts = np.frombuffer(part, np.int32).astype(np.int64)
            total[chunk] = total[chunk] + counts if chunk in total else counts
    if total:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())], ["chunk", "counts"]
        )


def frequency_classes(counts: DataFrame) -> np.ndarray:
    """One byte per bucket: its documents' count on a logarithmic scale. 2^20 bytes for any input."""
    rows = counts.repartition(min(CHUNKS, shuffle_width(counts.sparkSession)), "chunk").mapInArrow(_summed, "chunk int, counts binary")
    total = np.zeros((CHUNKS, (1 << BITS) // CHUNKS), np.int64)
    for r in rows.collect():  # CHUNKS rows, 8 MB in all
        total[r["chunk"]] = np.frombuffer(r["counts"], np.int64)
    return np.minimum(255, np.log2(total.ravel() + 1) * 6).astype(np.uint8)


def _postings(classes: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # copies within a task are posted once
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                out = []
                for text in batch.column(0).slice(at, 1000):
                    tokens = shingle_set(text.as_py(), WIDTH)
                    if not len(tokens) or (cid := set_id(tokens)) in seen:
                        continue
                    seen.add(cid)
                    first = prefix(tokens, classes.value, 0)
                    out.append((first.view(np.int64), cid, len(tokens)))
                if out:
                    lengths = np.array([len(p) for p, _, _ in out])
                    columns = [
                        np.concatenate([p for p, _, _ in out]),
                        np.repeat(np.array([c for _, c, _ in out], np.int64), lengths),
                        np.repeat(np.array([n for _, _, n in out], np.int32), lengths),
                        np.concatenate([np.arange(k, dtype=np.int32) for k in lengths]),
                    ]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["token", "cid", "n", "pos"])

    return run


def _lists(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[list[np.ndarray]]:
    """Columns of batches sorted by token, cut so that each token's rows come together."""
    rest = None
    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in names]
        if rest is not None:
            columns = [np.concatenate(p) for p in zip(rest, columns)]
        token = columns[0]
        cut = int(np.searchsorted(token, token[-1], "left")) if len(token) else 0
        if cut:
            yield [c[:cut] for c in columns]
        rest = [c[cut:] for c in columns]
    if rest is not None and len(rest[0]):
        yield rest


def _starts(token: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.flatnonzero(token[1:] != token[:-1]) + 1, [len(token)]])


_PAIRS = "a long, b long, token long, cid long, n int, pos int"


def _pair_batch(a, b) -> pa.RecordBatch:
    none = [pa.nulls(len(a), k) for k in (pa.int64(), pa.int64(), pa.int32(), pa.int32())]
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), *none], ["a", "b", "token", "cid", "n", "pos"])


def _hub_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per token list, ascending in size: each document with the list's hub, the first near enough in size; lists of three and more also as rows."""
    for token, cid, n, pos in _lists(batches, ["token", "cid", "n", "pos"]):
        keep = np.ones(len(token), bool)
        keep[1:] = (token[1:] != token[:-1]) | (cid[1:] != cid[:-1])  # a class posted by several tasks
        token, cid, n, pos = token[keep], cid[keep], n[keep], pos[keep]
        edges = _starts(token)
        size = np.diff(edges)
        a, b, long = [], [], np.zeros(len(token), bool)
        two = edges[:-1][size == 2]
        near = LEAST * n[two + 1] <= 100 * n[two]
        a.append(cid[two[near]])
        b.append(cid[two[near] + 1])
        for start, count in zip(edges[:-1][size > 2].tolist(), size[size > 2].tolist()):
            long[start : start + count] = True
            sizes, hubs, at = n[start : start + count], np.zeros(count, np.int64), 0
            while at < count:
                to = int(np.searchsorted(sizes, sizes[at] * 100 // LEAST, "right"))
                hubs[at:to] = at
                at = to
            members = np.flatnonzero(hubs != np.arange(count))
            a.append(cid[start + hubs[members]])
            b.append(cid[start + members])
        a, b = np.concatenate(a), np.concatenate(b)
        if len(a):
            pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
            yield _pair_batch(pairs[0], pairs[1])
        if long.any():
            none = pa.nulls(int(long.sum()), pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, *(pa.array(c[long]) for c in (token, cid, n, pos))], ["a", "b", "token", "cid", "n", "pos"])


def _center_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per token list: its center, the document with the most list places of all, with one document of every other label.

    A text that others were made from shares more lists with them than they share with each other.
    """
    for token, cid, n, degree, label in _lists(batches, ["token", "cid", "n", "degree", "label"]):
        edges = _starts(token)
        found: list[np.ndarray] = []
        for start, end in zip(edges[:-1].tolist(), edges[1:].tolist()):
            labels = label[start:end]
            if (labels == labels[0]).all():
                continue
            order = np.lexsort((cid[start:end], -degree[start:end]))
            center = start + order[0]
            _, first = np.unique(labels[order], return_index=True)  # the most central document of each label
            others = start + order[first]
            others = others[label[others] != label[center]]
            near = (LEAST * n[others] <= 100 * n[center]) & (LEAST * n[center] <= 100 * n[others])
            others = others[near]
            if len(others):
                x, y = np.full(len(others), cid[center]), cid[others]
                found.append(np.stack([np.minimum(x, y), np.maximum(x, y)]))
        if found:
            pairs = np.unique(np.concatenate(found, axis=1), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])


def _other_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per token list, all pairs of different labels that pass the length and positional filters, in blocks."""
    for token, cid, n, pos, label in _lists(batches, ["token", "cid", "n", "pos", "label"]):
        edges = _starts(token)
        found: list[np.ndarray] = []
        for start, end in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if (label[start:end] == label[start]).all():
                continue
            sizes = n[start:end].astype(np.int64)
            for i in range(end - start - 1):
                to = int(np.searchsorted(sizes, sizes[i] * 100 // LEAST, "right"))
                j = np.arange(i + 1, to)
                if not len(j):
                    continue
                j = j[label[start + j] != label[start + i]]
                alpha = (LEAST * (sizes[i] + sizes[j]) + 100 + LEAST - 1) // (100 + LEAST)
                most = 1 + np.minimum(sizes[i] - pos[start + i], sizes[j] - pos[start + j]) - 1
                j = j[most >= alpha]
                if len(j):
                    x, y = np.full(len(j), cid[start + i]), cid[start + j]
                    found.append(np.stack([np.minimum(x, y), np.maximum(x, y)]))
        if found:
            pairs = np.unique(np.concatenate(found, axis=1), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])


def _common(a: np.ndarray, b: np.ndarray) -> int:
    return len(np.intersect1d(a, b, assume_unique=True))


def is_linked(a: np.ndarray, b: np.ndarray) -> bool:
    both = _common(a, b)
    return 100 * both >= LEAST * (len(a) + len(b) - both)


def _verified(classes: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, tuple | None] = {}

        def sets(cid: int, text: str) -> tuple | None:
            """The set and its prefixes under the other orders; None where the text is another's that shares the id."""
            tokens = shingle_set(text, WIDTH)
            if set_id(tokens) != cid:
                return None
            if cid not in known:
                if len(known) >= 500:
                    known.clear()
                known[cid] = tokens, [np.sort(prefix(tokens, classes.value, k)) for k in range(1, len(ORDERS))]
            return known[cid]

        for batch in batches:
            rows = []
            for a, b, ta, tb in zip(*(c.to_pylist() for c in batch.columns)):
                x = known.get(a) or sets(a, ta)
                y = known.get(b) or sets(b, tb)
                # the filters of the other orders are intersected before whole sets are compared
                if x and y and all(_common(p, q) for p, q in zip(x[1], y[1])) and is_linked(x[0], y[0]):
                    rows.append((a, b))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["a", "b"])

    return run


def _links(docs: DataFrame, rows: DataFrame, pairs: DataFrame, classes: Broadcast) -> DataFrame:
    """Those of ``pairs`` (a, b: set ids) that are linked, stored.

    Pairs whose parities differ too much go before any text is read. Then one text per class in a pair is read again, found by its
    id and hash; texts travel instead of sets, as they pack to a fraction.
    """
    places = rows.join(_members(pairs), "cid", "left_semi").groupBy("cid", "doc_id", "key")
    places = places.agg(F.count("*").alias("_rows"), F.first("n").alias("n"), F.first("bits").alias("bits"))
    one = places.groupBy("cid").agg(F.min(F.struct("doc_id", "key", "_rows")).alias("_at"), F.first("n").alias("n"), F.first("bits").alias("bits"))
    one = stored(one, "wanted")
    sides = [one.select(F.col("cid").alias(c), F.col("n").alias(f"_n{c}"), F.col("bits").alias(f"_bits{c}")) for c in ("a", "b")]
    near = pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "_na", "_bitsa", "_nb", "_bitsb")
    pairs = stored(near.mapInArrow(_near_enough, "a long, b long"), "near_pairs")
    places = one.join(_members(pairs), "cid", "left_semi").select("cid", F.col("_at.doc_id").alias("_id"), F.col("_at.key").alias("_key"), "_at._rows")
    places = broadcast_if_small(stored(places, "places"))
    keyed = docs.withColumn("_text_key", _text_key())
    found = keyed.join(places, keyed["doc_id"].eqNullSafe(places["_id"]) & (keyed["_text_key"] == places["_key"]))
    again = found.where("_rows > 1").dropDuplicates(["cid"])  # rows repeated whole
    texts = stored(found.where("_rows = 1").unionByName(again).select("cid", "text"), "texts")
    both = pairs.join(texts.select(F.col("cid").alias("a"), F.col("text").alias("_ta")), "a")
    both = both.join(texts.select(F.col("cid").alias("b"), F.col("text").alias("_tb")), "b").select("a", "b", "_ta", "_tb")
    return stored(both.mapInArrow(_verified(classes), "a long, b long"), "links")


def _members(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("cid")).unionByName(pairs.select(F.col("b").alias("cid"))).distinct()


def near_classes(docs: DataFrame) -> DataFrame:
    """doc_id, ``n_shingles`` and ``component_id`` of every row of ``docs`` (doc_id, text).

    Words are lower-cased (A-Z) and parted by ASCII white space; a document's set is its distinct five-word shingles,
    or all its words as one where they are fewer. Documents link when their sets' Jaccard similarity is 0.8 or more;
    ``component_id`` is the smallest doc_id reachable by links. A null or empty text has no set, links with nothing and is its own
    component. Rows of equal sets are one class whatever their ids; a null id counts only where a component has no other. Shingles
    and classes are told apart by 64-bit hashes. Other columns are ignored; an empty table gives no rows.

    Candidates share a token in the prefixes of the first order, where every token list pairs its members
    with a hub. Then, twice, every list's center meets one document of each component that the list still holds; only after that
    all pairs of different components are tried. Large groups of near copies thus cost about one pair per member and list,
    and no link between components is left out. The prefixes under the other orders are intersected before two sets are compared.
    """
    grouped, rows = _grouped(docs)
    smallest = grouped.groupBy("_c").agg(F.min("doc_id").alias("component_id"))
    full = grouped.join(smallest, "_c").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return full.unionByName(rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def _text_key() -> Column:
    """Tells rows of one doc_id apart."""
    return F.xxhash64(F.col("text").cast("string"))


def _grouped(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with shingles: doc_id, ``key`` of the text, ``n`` shingles and component ``_c``, stored; and all rows: doc_id, key, n, cid."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = docs.select("doc_id", "text", _text_key().alias("key"))
    seen = stored(signed.mapInArrow(_signatures, "doc_id long, key long, n long, cid long, bits binary, chunk int, counts binary"), "signatures")
    rows = seen.where("chunk is null").select("doc_id", "key", "n", "cid", "bits")
    classes = docs.sparkSession.sparkContext.broadcast(frequency_classes(seen.where("chunk is not null").select("chunk", "counts")))
    width = shuffle_width(docs.sparkSession)
    posted = docs.select("text").mapInArrow(_postings(classes), "token long, cid long, n int, pos int")
    posted = posted.repartition(width, "token").sortWithinPartitions("token", "n", "cid")
    first = stored(posted.mapInArrow(_hub_pairs, _PAIRS), "hubs")
    pairs = stored(first.where("token is null").select("a", "b").distinct(), "pairs")
    links = _links(docs, rows, pairs, classes)
    labels = components(links)
    lists = first.where("token is not null").select("token", "cid", "n", "pos")
    degrees = lists.groupBy("cid").agg(F.count("*").alias("degree"))
    lists = stored(lists.join(degrees, "cid"), "lists")

    def labelled() -> DataFrame:
        """List places with their documents' labels so far, each list's together."""
        named = lists.join(labels.withColumnRenamed("node", "cid"), "cid", "left").withColumn("label", F.coalesce("label", "cid"))
        return named.repartition(width, "token").sortWithinPartitions("token", "n", "cid")

    for candidates in (_center_pairs, _center_pairs, _other_pairs):
        more = labelled().mapInArrow(candidates, "a long, b long").distinct().join(pairs, ["a", "b"], "left_anti")
        more = stored(more, "more_pairs")
        if not more.isEmpty():
            links = links.unionByName(_links(docs, rows, more, classes))
            labels = components(links)
            pairs = stored(pairs.unionByName(more), "pairs")
    named = rows.where("n > 0").join(labels.withColumnRenamed("node", "cid"), "cid", "left")
    return stored(named.select("doc_id", "key", "n", F.coalesce("label", "cid").alias("_c")), "grouped"), rows


def drop_near(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component, one of the smallest doc_id; all columns stay.

    A null id comes after all others. Rows repeating an id are told apart by their texts, rows repeating both are reduced
    to one of them; documents without words all stay.
    """
    grouped, _ = _grouped(docs)
    places = grouped.groupBy("_c", "doc_id", "key").agg(F.count("*").alias("_n"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    first = grouped.groupBy("_c").agg(F.min(order).alias("_first"), F.count("*").alias("_rows")).where("_rows > 1")
    marked = places.join(first, "_c").select(
        F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "_n", (F.col("doc_id").eqNullSafe(F.col("_first.doc_id")) & (F.col("key") == F.col("_first.key"))).alias("_stays")
    )
    marked = stored(marked, "marked")
    # the row as one struct, so that no column of it can clash
    keyed = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("row_id"), _text_key().alias("text_key"))

    def on(side: DataFrame) -> Column:
        return (keyed["text_key"] == side["_key"]) & keyed["row_id"].eqNullSafe(side["_id"])

    gone = broadcast_if_small(marked.where("not _stays or _n > 1"))
    kept = keyed.join(gone, on(gone), "left_anti")
    twice = broadcast_if_small(marked.where("_stays and _n > 1"))
    one = keyed.join(twice, on(twice), "left_semi").dropDuplicates(["row_id", "text_key"])
    return kept.unionByName(one).select("row.*")
