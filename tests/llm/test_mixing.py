from collections import Counter
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rowtide.llm import mixing

WEIGHTS = st.dictionaries(st.sampled_from("abcdef"), st.integers(1, 9), min_size=1, max_size=6)


@given(WEIGHTS)
@settings(max_examples=200, deadline=None)
def test_a_stream_is_less_than_one_block_off_its_share(weights):
    total, placed = sum(weights.values()), Counter()
    for slot, (name, j, at, release, deadline) in enumerate(mixing.pattern(weights)):
        assert at == slot and j == placed[name] and release <= slot < deadline
        placed[name] += 1
        for s, q in weights.items():
            assert abs(placed[s] - Fraction(q * (slot + 1), total)) < 1
    assert placed == weights


@given(WEIGHTS, st.data())
@settings(max_examples=100, deadline=None)
def test_phases_place_every_block_once(weights, data):
    blocks = {s: data.draw(st.integers(0, 40)) for s in weights}
    slots, slot = Counter(), 0
    for i, p in enumerate(mixing.phases(blocks, weights)):
        assert p.slot == slot
        for at in range(p.length):
            slots[p.pattern[at % p.period][0]] += 1
        slot += p.length
    assert slots == Counter({s: n for s, n in blocks.items() if n}) and slot == sum(blocks.values())


@pytest.fixture
def rows():
    big = [(i, f"text {i}", "big") for i in range(400)]
    return big + [(1000 + i, "t", "small") for i in range(37)] + [(2000 + i, "t", None) for i in range(21)] + [(None, None, "big"), (5, "text 5", "big"), (5, "text 5", "big")]


def test_mix(documents, rows):
    weights = {"big": 2, "small": 1, mixing.REST: 1}
    got = sorted(mixing.mix(documents(rows), weights, block_rows=8, seed=3).collect(), key=lambda r: r.position)
    assert [r.position for r in got] == list(range(len(rows)))
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    assert all(r.release <= r.slot < r.deadline for r in got)
    names = {"big": "big", "small": "small", None: mixing.REST}
    assert Counter(r.stream for r in got) == Counter(names[r[2]] for r in rows)
    blocks = sorted({(r.slot, r.stream, r.block) for r in got})
    assert [b[0] for b in blocks] == list(range(len(blocks)))
    placed = Counter()
    first = [b for b in blocks if b[0] < min(r.slot for r in got if r.phase == 1)]
    for slot, stream, block in first:
        assert block == placed[stream]
        placed[stream] += 1
        for s, q in weights.items():
            assert abs(placed[s] - Fraction(q * (slot + 1), 4)) < 1
    again = mixing.mix(documents(rows, parts=5), weights, block_rows=8, seed=3).collect()
    assert Counter((r.doc_id, r.slot) for r in again) == Counter((r.doc_id, r.slot) for r in got)


def test_mixed_rows_come_in_that_order(documents, rows, spark, tmp_path):
    docs = documents(rows)
    order = sorted(mixing.mix(docs, {"big": 1}, block_rows=4, seed=3).collect(), key=lambda r: r.position)
    got = mixing.mixed(docs, {"big": 1}, block_rows=4, seed=3)
    assert got.columns == docs.columns
    assert [r.doc_id for r in got.collect()] == [r.doc_id for r in order]


def test_weights_are_whole_numbers(documents):
    with pytest.raises(ValueError):
        mixing.mix(documents([(1, "x")]), {"a": 0})


def test_empty_table(documents):
    assert mixing.mix(documents([(1, "x")]).where("false"), {"a": 1}).count() == 0
