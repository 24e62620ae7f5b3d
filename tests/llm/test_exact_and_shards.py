import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rowtide.llm import exact, sharding
from rowtide.llm.tables import numbered


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def key(i):
    return float("-inf") if i is None else i


def expected_exact(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[lowered(t)].append(i)
    out = []
    for text, ids in groups.items():
        keep = max(ids, key=key)
        first = True
        for i in sorted(ids, key=key):
            kept = i == keep and first
            first = first and not kept
            out.append((i, keep, len(ids), kept, sha256(text.encode()).hexdigest()))
    return Counter(out)


def test_exact_classes(documents, odd_rows):
    rows = odd_rows + [(100 + i, "one hot text of many copies") for i in range(300)]
    got = exact.exact_classes(documents(rows), carry={"sha": exact.full_hash()})
    assert Counter(tuple(r) for r in got.collect()) == expected_exact(rows)


def test_exact_same_length_and_prefix(documents):
    rows = [(i, "x" * 64 + "ab"[i % 2] * 5) for i in range(4)] + [(9, "y" * 69)]
    got = {r.doc_id: (r.keep_id, r.kept) for r in exact.exact_classes(documents(rows)).collect()}
    assert got == {0: (2, False), 2: (2, True), 1: (3, False), 3: (3, True), 9: (9, True)}


def test_texts_seen_once_are_not_hashed(documents):
    rows = exact.refined(documents([(1, "alone"), (2, "twice"), (3, "twice"), (4, "tw")])).collect()
    assert {r.doc_id: r.full is None for r in rows} == {1: False, 2: False, 3: False, 4: True} or {
        r.doc_id: r.full is None for r in rows
    } == {1: True, 2: False, 3: False, 4: True}


def test_drop_exact_hashes_no_text_seen_once(documents, monkeypatch):
    from pyspark.sql import functions as F

    plain = exact.full_hash

    def guarded(text="text"):
        raw = F.col(text) if isinstance(text, str) else text
        return F.when(raw == "alone", F.raise_error(F.lit("hashed whole")).cast("string")).otherwise(plain(text))

    monkeypatch.setattr(exact, "full_hash", guarded)
    got = exact.drop_exact(documents([(1, "alone"), (2, "twice so"), (3, "Twice so"), (3, "twice so"), (None, "tw"), (None, "tw")]))
    assert sorted((str(r.doc_id), r.text.lower()) for r in got.collect()) == [("1", "alone"), ("3", "twice so"), ("None", "tw")]


def test_drop_exact_keeps_columns_and_one_of_each(documents, odd_rows):
    docs = documents(odd_rows)
    got = exact.drop_exact(docs)
    assert got.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter(
        {(i, t): 1 for i, t in {(i, t) for i, t in odd_rows} - {(1, odd_rows[0][1]), (3, None), (4, ""), (None, None), (8, "two words"), (None, odd_rows[11][1])}}
    ) + Counter([(4, "")])


def test_empty_table(documents):
    none = documents([(1, "x")]).where("false")
    assert exact.exact_classes(none).count() == exact.drop_exact(none).count() == 0
    assert sharding.shard_documents(none).count() == 0


@given(st.integers(1, 5000), st.integers(0, 9))
@settings(max_examples=40, deadline=None)
def test_permutation_is_one_to_one(n, seed):
    places = [sharding.permuted(r, n, seed) for r in range(n)]
    assert sorted(places) == list(range(n))
    assert [sharding.original(p, n, seed) for p in places] == list(range(n))


@pytest.mark.parametrize("n", [2**31 + 7, 10**12])
def test_permutation_of_large_tables(spark, n):
    from pyspark.sql import functions as F

    rows = [0, 1, n // 3, n - 1]
    got = [r[0] for r in spark.createDataFrame([(r,) for r in rows], "r long").select(sharding.permutation(F.col("r"), n, 3)).collect()]
    assert got == [sharding.permuted(r, n, 3) for r in rows]
    assert [sharding.original(p, n, 3) for p in got] == rows


def test_shards(documents, odd_rows):
    rows = odd_rows + [(50 + i, "same") for i in range(90)]
    got = sharding.shard_documents(documents(rows), 8, 17).collect()
    assert len(got) == len(rows)
    slots = defaultdict(list)
    for r in got:
        place = sharding.permuted(r.row_no, len(rows), 17)
        assert (r.shard, r.slot) == (place % 8, place // 8)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows
    )
    again = sharding.shard_documents(documents(rows, parts=7), 8, 17).collect()
    assert {(r.doc_id, r.text_crc32, r.shard, r.slot) for r in again} == {(r.doc_id, r.text_crc32, r.shard, r.slot) for r in got}


def test_numbers_restart_per_group(spark):
    rows = [(g, i * 7 % 50) for g in ("a", "b", None) for i in range(50 if g == "a" else 3)]
    got = numbered(spark.createDataFrame(rows, "g string, v int"), ["v"], group="g").collect()
    by = defaultdict(list)
    for r in got:
        by[r.g].append((r.v, r.row_no))
    for g, found in by.items():
        assert [n for _, n in sorted(found)] == list(range(len(found)))


def test_clashing_names_stay(documents):
    names = ["_n_bytes", "_prefix", "_full", "row", "row_id", "row_full"]
    docs = documents([(1, "same"), (2, "SAME"), (2, "SAME"), (3, "other")]).withColumns({c: F.lit(c) for c in names})
    out = exact.drop_exact(docs)
    assert out.columns == docs.columns
    assert sorted((r.doc_id, *[r[c] for c in names]) for r in out.collect()) == [(2, *names), (3, *names)]
