"""Prefix trie of conversations, rolled up in bands of depth.

A node is a distinct sequence of first turns. Its identity is the sum of digests of (place, turn) over the sequence, so
prefix sums over a conversation name all its nodes, and a conversation of any length may be cut into bands of places that
are summed apart. A node's weights go to its ancestors in its own band only; the roots of bands form a trie of their
own, ``band`` times lower, that is rolled up the same way, and their completed totals then go to the nodes of the band
above. So a row is exploded ``band``-fold at most, and rounds grow with the logarithm of the depth.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowtide.llm.tables import stored
from rowtide.operators.ranking import ranked
from rowtide.session import shuffle_width

BAND = 16
WORD = r"[^\x20\x09-\x0D]+"
#: Two digests of 58 bits each: up to 16 of them and an earlier sum stay within 64 bits, so bands have 16 places at most.
MASK = (1 << 58) - 1
_NO_IDS = hashlib.sha256(b"").hexdigest()


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, ``pos`` (from 1), role, text of every turn in order, stored.

    Ordered by turn (null first), ties by role, then text; rows repeated are turns of their own. Null role or text is
    empty. Rows without conv_id belong to no conversation and are left out. A conversation of any size is
    spread over the tasks.
    """
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    numbered = ranked(rows, ["conv_id"], ["turn", "role", "text"], rank="pos")
    return stored(numbered.select("conv_id", "pos", "role", "text"), "turns")


def shared_openings(turns: DataFrame, period: int = 20, openings: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations that open like their neighbour: turns (conv_id, pos, role, text, ``is_end``) and sizes (conv_id, ``n_turns``).

    Conversation c takes the first h turns of conversation c - c % ``period`` (all if fewer, none if absent) in place of
    its own first h; h is the CRC-32 of its decimal number modulo ``openings``.
    """
    own = turns.groupBy("conv_id").agg(F.max("pos").alias("_n"))
    base = F.col("conv_id") - F.col("conv_id") % period
    h = (F.crc32(F.col("conv_id").cast("string")) % openings).cast("int")
    others = own.select(F.col("conv_id").alias("_base"), F.col("_n").alias("_base_n"))
    sizes = own.select("conv_id", "_n", base.alias("_base"), h.alias("_h")).join(others, "_base", "left")
    sizes = sizes.withColumn("_taken", F.least("_h", F.coalesce("_base_n", F.lit(0))).cast("long"))
    sizes = sizes.withColumn("n_turns", F.col("_taken") + F.greatest(F.col("_n") - F.col("_h"), F.lit(0)))
    sizes = stored(sizes.select("conv_id", "_base", "_h", "_taken", "n_turns"), "sizes")
    pos = F.col("pos") - F.col("_h") + F.col("_taken")
    tails = turns.join(sizes, "conv_id").where(F.col("pos") > F.col("_h")).withColumn("pos", pos)
    # at most openings - 1 turns of a base, each for fewer than period conversations
    first = turns.where(F.col("pos") < openings).withColumnRenamed("conv_id", "_base")
    heads = first.join(sizes, "_base").where(F.col("pos") <= F.col("_taken"))
    columns = ["conv_id", "pos", "role", "text", (F.col("pos") == F.col("n_turns")).alias("is_end")]
    return tails.select(*columns).unionByName(heads.select(*columns)), sizes.select("conv_id", "n_turns")


def plain_conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations as they are, in the shape of :func:`shared_openings`."""
    sizes = stored(turns.groupBy("conv_id").agg(F.max("pos").alias("n_turns")), "sizes")
    marked = turns.join(sizes, "conv_id").select("conv_id", "pos", "role", "text", (F.col("pos") == F.col("n_turns")).alias("is_end"))
    return marked, sizes


def _div(value: Column, by: int) -> Column:
    return F.call_function("div", value, F.lit(by)).cast("long")


def _masked(value: Column) -> Column:
    return value.bitwiseAND(F.lit(MASK))


def _earlier(rows: DataFrame, band: int) -> DataFrame:
    """conv_id, ``at``, and the sums ``_a0``, ``_b0`` of a conversation's rows before ``at``; rows are one per place, from 0 on."""
    most = rows.agg(F.max("at")).first()[0]
    up = rows.withColumn("_up", _div(F.col("at"), band))
    before = Window.partitionBy("conv_id", "_up").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    own = up.withColumns({c: F.coalesce(F.sum(v).over(before), F.lit(0)) for c, v in (("_a0", "a"), ("_b0", "b"))})
    if most is None or most < band:
        return own.select("conv_id", "at", _masked(F.col("_a0")).alias("_a0"), _masked(F.col("_b0")).alias("_b0"))
    totals = up.groupBy("conv_id", F.col("_up").alias("at")).agg(*[_masked(F.sum(c)).alias(c) for c in ("a", "b")])
    above = _earlier(stored(totals, "band_totals"), band).select("conv_id", F.col("at").alias("_up"), F.col("_a0").alias("_a1"), F.col("_b0").alias("_b1"))
    out = own.join(above, ["conv_id", "_up"])
    return out.select("conv_id", "at", _masked(F.col("_a0") + F.col("_a1")).alias("_a0"), _masked(F.col("_b0") + F.col("_b1")).alias("_b0"))


def _chain(turns: DataFrame, band: int) -> DataFrame:
    """Every turn as a step from one node to the next: conv_id, pos, node (a, b), parent (pa, pb), words, ``is_end``; stored."""
    role_text = F.xxhash64("role", "text"), F.xxhash64(F.lit("b"), "text", "role")
    steps = turns.select(
        "conv_id",
        "pos",
        "is_end",
        F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"),
        _masked(F.xxhash64(F.col("pos"), role_text[0])).alias("xa"),
        _masked(F.xxhash64(role_text[1], F.col("pos"))).alias("xb"),
    )
    steps = stored(steps.withColumn("at", _div(F.col("pos"), band)), "steps")
    so_far = Window.partitionBy("conv_id", "at").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = steps.withColumns({"a": _masked(F.sum("xa").over(so_far)), "b": _masked(F.sum("xb").over(so_far))})
    most = steps.agg(F.max("at")).first()[0]
    if most:
        totals = steps.groupBy("conv_id", "at").agg(_masked(F.sum("xa")).alias("a"), _masked(F.sum("xb")).alias("b"))
        sums = sums.join(_earlier(stored(totals, "band_totals"), band), ["conv_id", "at"])
        sums = sums.withColumns({"a": _masked(F.col("a") + F.col("_a0")), "b": _masked(F.col("b") + F.col("_b0"))})
    parent = _masked(F.col("a") - F.col("xa")).alias("pa"), _masked(F.col("b") - F.col("xb")).alias("pb")
    return stored(sums.select("conv_id", "pos", "a", "b", *parent, "words", "is_end"), "chain")


def _root_id() -> Column:
    return F.struct(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))


def _with_paths(chain: DataFrame, band: int) -> DataFrame:
    """Adds ``path``: the nodes from the root of the step's band down to the step's own, at most ``band``."""
    rows = chain.withColumn("_band", _div(F.col("pos"), band))
    so_far = Window.partitionBy("conv_id", "_band").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    path = F.collect_list(F.struct("a", "b")).over(so_far)
    return rows.withColumn("path", F.when(F.col("_band") == 0, F.concat(F.array(_root_id()), path)).otherwise(path)).drop("_band")


def _summed(rows: DataFrame, by: list[str]) -> DataFrame:
    return rows.groupBy(*by).agg(F.sum("leaves").alias("leaves"), F.sum("tokens").alias("tokens"))


def _subtree_sums(nodes: DataFrame, chain: DataFrame, band: int) -> DataFrame:
    """a, b, ``leaves``, ``tokens`` summed over each node's subtree, itself included.

    ``nodes``: a, b, pa, pb, depth, path, leaves, tokens (its own). ``chain``: conv_id, pos, a, b.
    """
    shares = nodes.select(F.explode("path").alias("_id"), "leaves", "tokens").select("_id.a", "_id.b", "leaves", "tokens")
    in_band = _summed(shares, ["a", "b"])
    if (nodes.agg(F.max("depth")).first()[0] or 0) < band:
        return in_band
    in_band = stored(in_band, "in_band")
    heads = nodes.where((F.col("depth") % band == 0) & (F.col("depth") > 0)).select("a", "b", "pa", "pb", _div(F.col("depth"), band).alias("depth"))
    parents = nodes.select(F.col("a").alias("pa"), F.col("b").alias("pb"), "path")
    upper_chain = stored(chain.where(F.col("pos") % band == 0).select("conv_id", _div(F.col("pos"), band).alias("pos"), "a", "b"), "upper_chain")
    paths = _with_paths(upper_chain, band).groupBy("a", "b").agg(F.first("path").alias("path"))
    above = heads.join(parents.select("pa", "pb", F.get("path", F.lit(0)).alias("_top")), ["pa", "pb"])
    upper = above.select("a", "b", F.col("_top.a").alias("pa"), F.col("_top.b").alias("pb"), "depth")
    upper = stored(upper.join(paths, ["a", "b"]).join(in_band, ["a", "b"]), "band_roots")
    done = stored(_subtree_sums(upper, upper_chain, band), "completed")
    crossing = _summed(heads.join(done, ["a", "b"]), ["pa", "pb"]).join(parents, ["pa", "pb"])
    crossing = crossing.select(F.explode("path").alias("_id"), "leaves", "tokens").select("_id.a", "_id.b", "leaves", "tokens")
    return _summed(in_band.unionByName(crossing), ["a", "b"])


# -- digests of the conversations that end at a node ----------------------------------------------

_BLOB = 1 << 15
_RUNS = "a long, b long, first long, sha256 string, ids binary"


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (a, b, conv_id) in that order. A node's ids wholly inside the task become a digest; others, and long ones, blobs."""
    node: tuple[int, int] | None = None
    parts: list[str] = []
    first = size = 0
    opened = True  # the task's first run may go on from another task
    rows: list[tuple] = []

    def blob() -> tuple:
        return (*node, first, None, ",".join(parts).encode())

    for batch in batches:
        for a, b, conv in zip(*(c.to_pylist() for c in batch.columns)):
            if (a, b) != node:
                if node is not None:
                    rows.append(blob() if opened else (*node, first, hashlib.sha256(",".join(parts).encode()).hexdigest(), None))
                    opened = False
                node, parts, first, size = (a, b), [], conv, 0
            elif size > _BLOB:
                rows.append(blob())
                parts, first, size, opened = [], conv, 0, True
            parts.append(str(conv))
            size += len(parts[-1]) + 1
        if rows:
            yield _run_batch(rows)
            rows = []
    if node is not None:
        yield _run_batch([blob()])  # it may go on in the next task


def _run_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["a", "b", "first", "sha256", "ids"])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blobs (a, b, ids) of whole nodes in order: digests; a batch of Arrow holds some thousand blobs of 32 KB."""
    node, digest, rows = None, None, []
    for batch in batches:
        for a, b, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            if (a, b) != node:
                if node is not None:
                    rows.append((*node, digest.hexdigest()))
                node, digest = (a, b), hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.as_py())
        if rows:
            yield _digest_batch(rows)
            rows = []
    if node is not None:
        yield _digest_batch([(*node, digest.hexdigest())])


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.int64(), pa.string()))], ["a", "b", "sha256"])


def end_digests(ends: DataFrame) -> DataFrame:
    """a, b, ``sha256`` of the comma-joined ascending ids of the conversations that end at a node (``ends``: a, b, conv_id).

    Rows are dealt by ranges of node and id, so a node where very many end spreads over the tasks, which turn their
    ids into a few blobs of text. SHA-256 takes its bytes in order: only the blobs of such a node pass through one task, one by one.
    """
    by = ["a", "b", "conv_id"]
    width = shuffle_width(ends.sparkSession)
    runs = stored(ends.select(*by).repartitionByRange(width, *by).sortWithinPartitions(*by).mapInArrow(_runs, _RUNS), "runs")
    cut = runs.where("sha256 is null").repartition("a", "b").sortWithinPartitions("a", "b", "first")
    whole = cut.select("a", "b", "ids").mapInArrow(_joined, "a long, b long, sha256 string")
    return runs.where("sha256 is not null").select("a", "b", "sha256").unionByName(whole)


def prefix_trie(turns: DataFrame, sizes: DataFrame, band: int = BAND) -> DataFrame:
    """One row per node of the conversations' prefix trie.

    ``turns`` (conv_id, pos from 1 without gaps, role, text, ``is_end``) and ``sizes`` (conv_id, ``n_turns``, 0 for one without
    turns) come from :func:`shared_openings` or :func:`plain_conversations`. Columns: ``conv_id``, the smallest member, which with ``depth``
    names the node (its last text is that conversation's turn ``depth``); ``parent_conv_id``; ``n_convs``; ``n_children``;
    ``n_leaves`` and ``saved_tokens`` over the subtree; ``ends_sha256``. The root (depth 0) has all conversations; no conversations,
    no rows. ``band`` is 2 to 16.
    """
    if not 2 <= band <= 16:
        raise ValueError("a band has 2 to 16 places")
    chain = _chain(turns, band)
    nodes = _with_paths(chain, band).groupBy("a", "b").agg(
        F.first("pos").alias("depth"),
        F.first("pa").alias("pa"),
        F.first("pb").alias("pb"),
        F.first("path").alias("path"),
        F.first("words").alias("words"),
        F.count("*").alias("n_convs"),
        F.min("conv_id").alias("conv_id"),
    )
    none = F.lit(None).cast("long")
    root = sizes.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0")
    zero = F.lit(0).cast("long")
    root = root.withColumns({"a": zero, "b": zero, "depth": zero, "pa": none, "pb": none, "path": F.array(_root_id()), "words": zero})
    nodes = stored(nodes.unionByName(root), "nodes")
    children = nodes.where("pa is not null").groupBy(F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, ["a", "b"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = nodes.withColumns({"leaves": (F.col("n_children") == 0).cast("long"), "tokens": (F.col("n_convs") - 1) * F.col("words")})
    nodes = stored(nodes, "weighted")
    sums = _subtree_sums(nodes.select("a", "b", "pa", "pb", "depth", "path", "leaves", "tokens"), chain.select("conv_id", "pos", "a", "b"), band)
    ends = chain.where("is_end").select("a", "b", "conv_id").unionByName(sizes.where("n_turns = 0").select(zero.alias("a"), zero.alias("b"), "conv_id"))
    parents = nodes.select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.drop("leaves", "tokens").join(sums, ["a", "b"]).join(end_digests(ends), ["a", "b"], "left").join(parents, ["pa", "pb"], "left")
    return out.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        F.col("leaves").alias("n_leaves"),
        F.col("tokens").alias("saved_tokens"),
        F.coalesce("sha256", F.lit(_NO_IDS)).alias("ends_sha256"),
    )
