import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from rowtide.llm import prefix_trie as pt
from rowtide.llm import queries

SCHEMA = "conv_id long, turn long, role string, text string, pos string, a string, path string, n_turns string"


def brute(rows, openings=True):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    rebuilt = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4 if openings else 0
        rebuilt[c] = own.get(c - int(abs(c) % 20 * (1 if c >= 0 else -1)), [])[:h] + ts[h:]
    members, kids, ends = defaultdict(list), defaultdict(set), defaultdict(list)
    for c in sorted(rebuilt):
        ts = tuple(rebuilt[c])
        for d in range(len(ts) + 1):
            members[ts[:d]].append(c)
            if d:
                kids[ts[: d - 1]].add(ts[:d])
        ends[ts].append(c)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        leaves[node] = sum(leaves[k] for k in kids[node]) if kids[node] else 1
        saved[node] = (len(members[node]) - 1) * words + sum(saved[k] for k in kids[node])
    out = []
    for node, cs in members.items():
        digest = hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest()
        parent = min(members[node[:-1]]) if node else None
        out.append((min(cs), len(node), parent, len(cs), len(kids[node]), leaves[node], saved[node], digest))
    return sorted(out, key=repr)


@pytest.fixture
def table(spark):
    def make(rows, parts=3):
        return spark.createDataFrame([(*r, "p", "q", "r", "s") for r in rows], SCHEMA).repartition(parts)

    return make


def trie(df, band=16, openings=True):
    turns = pt.ordered_turns(df)
    return pt.prefix_trie(*(pt.shared_openings(turns) if openings else pt.plain_conversations(turns)), band=band)


def random_rows(seed, convs=90, most=9, texts=("a", "b b", "c  c\tc", "")):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "bot", None]), rng.choice([*texts, None])) for c in rng.sample(range(-40, 2 * convs), convs) for t in range(rng.randint(1, most))]


@pytest.mark.parametrize(("band", "most"), [(16, 9), (2, 9), (3, 40)])
def test_against_brute_force(table, rows, band, most):
    data = random_rows(band, most=most, texts=("a",) if most > 9 else ("a", "b b", "c  c\tc", ""))
    for openings in (True, False):
        assert rows(trie(table(data), band, openings)) == brute(data, openings)


def test_deep_conversations_take_rounds_by_the_logarithm(table, rows):
    data = [(c, t, "u", f"w{t} x" if t < 30 * c else f"own{c} {t}") for c in range(1, 6) for t in range(130)]
    assert rows(trie(table(data), 4)) == brute(data)


def test_odd_rows(table, rows):
    data = [
        (1, None, None, None), (1, 0, "user", "hi there"), (1, 0, "user", "hi there"), (1, 0, "bot", "hi"), (None, 1, "user", "lost"),
        (7, 3, "user", "x"), (40, 5, "user", " \n"), (41, 5, "user", "a " * 40_000), (41, 5, "user", "a " * 40_000 + "b"), (2**40, 1, "", ""), (3, 1, "user", "only"),
    ]
    assert rows(trie(table(data))) == brute(data)
    assert trie(table([])).count() == 0 and trie(table([(None, 1, "a", "b")])).count() == 0


def test_a_conversation_without_turns_is_a_member_of_the_root(table, rows):
    c = next(c for c in range(21, 200) if c % 20 and zlib.crc32(str(c).encode()) % 4 == 3)
    got = rows(trie(table([(c, 0, "user", "a"), (c, 1, "user", "b")])))
    assert got == brute([(c, 0, "user", "a"), (c, 1, "user", "b")]) and [r[:2] for r in got] == [(c, 0)]


def test_hot_prefix_hot_conversation_and_many_ends(table, rows):
    data = [(c, t, "s", f"same {t}") for c in range(600) for t in range(3)] + [(9999, t, "u", f"t{t}") for t in range(900)]
    assert rows(trie(table(data, 8))) == brute(data)


def test_blobs_of_a_node_that_spans_tasks(spark, monkeypatch):
    monkeypatch.setattr(pt, "_BLOB", 10)
    ends = spark.createDataFrame([(n % 3 // 2, 5, n) for n in range(500)] + [(7, 7, -3)], "a long, b long, conv_id long")
    want = defaultdict(list)
    for n in range(500):
        want[n % 3 // 2, 5].append(str(n))
    want[7, 7] = ["-3"]
    got = {(r.a, r.b): r.sha256 for r in pt.end_digests(ends).collect()}
    assert got == {k: hashlib.sha256(",".join(v).encode()).hexdigest() for k, v in want.items()}


def test_whole_table(spark, rows):
    data = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows(queries.op12_prefix_trie(spark, "/root/testdata/sf0.001")) == brute(data)


def test_band_bounds(table):
    with pytest.raises(ValueError):
        trie(table([(1, 1, "a", "b")]), band=17)
