import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rowtide.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = "á ́b İSTANBUL Σας ς Ω, ß. <|endoftext|> x<|startoftext|>y it's I'LL\x1cq\x85z　k 日本語\x0bfoo\x00bar ''s d's. foo's, 12a. a12, ﬁ, ª. naïve, Über; ŉ ǅ! |"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")


def test_ids_equal_the_tokenizers(tokenizer, spark):
    texts = [ODD, "", *[r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]]
    known = packing.WordIds(PATH)
    words = [t.encode().split() for t in texts]
    known.learn(words)
    for text, w in zip(texts, words):
        assert known.ids(w) + b"\2\0\0\0" == ids_of(tokenizer, text).tobytes()


MARKED = ["ANONİM ŞİRKETİ.", "İSTANBUL İLİ,", "İ.", "okİ|", "\u0958|", "x\u0958!", "e\u0301.", "\u212b,", "ΣΑΣ.", "ŉ.", "ǰ|", "Ω;"]


def check(known, tokenizer, text):
    words = text.encode().split()
    known.learn([words])
    assert known.ids(words) + b"\2\0\0\0" == ids_of(tokenizer, text).tobytes(), text


def test_letters_whose_lower_case_ends_in_a_mark(tokenizer):
    known = packing.WordIds(PATH)
    for text in MARKED:
        check(known, tokenizer, text)


_KNOWN = packing.WordIds(PATH)
_LETTERS = st.characters(categories=["L", "M"], codec="utf-8")
_ANY = st.one_of(_LETTERS, st.sampled_from(list(".,;:!?|'-") + ["İ", "\u0958", "\u0307", " "]), st.characters(codec="utf-8"))


@settings(max_examples=3000, deadline=None)
@given(st.text(_ANY, max_size=6), st.sampled_from(["", ".", ",", "|", "!?", ";x"]))
def test_any_letters_before_punctuation(text, end):
    check(_KNOWN, _KNOWN.tokenizer, text + end)


def test_every_id_in_one_piece_without_gaps(documents, odd_rows, tokenizer):
    rows = odd_rows + [(100 + i, "some words " * (i % 90)) for i in range(300)]
    docs = documents(rows, parts=4)
    pieces = packing.pack(docs, PATH, room=256, most_open=4, windows_per_merge=2, with_ids=True).collect()
    assert len({r.doc_id for r in pieces}) == len({i for i, _ in rows})
    fill = defaultdict(list)
    for p in pieces:
        assert p.length * 4 == len(p.ids) and zlib.crc32(p.ids) == p.ids_crc32
        fill[p.sequence_id].append((p.offset, p.length))
    for spans in fill.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= 256
    whole = defaultdict(list)
    for p in pieces:
        whole[p.doc_id].append((p.start, p.ids, p.doc_tokens))
    for i, t in rows:
        if i not in (None, 9):
            want = ids_of(tokenizer, t)
            assert b"".join(b for _, b, _ in sorted(whole[i])) == want.tobytes()
            assert {n for _, _, n in whole[i]} == {len(want)}
    assert sum(p.length for p in pieces) == sum(len(ids_of(tokenizer, t)) for _, t in rows)


def test_little_padding(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = packing.pack(docs, PATH, room=4096).groupBy("sequence_id").sum("length").collect()
    assert sum(r[1] for r in found) / (4096 * len(found)) > 0.95


def test_windows_stay_bounded_and_best_fit():
    w = packing.Windows(10, 2)
    assert w.put(6, "a") is None and w.put(7, "b") is None
    assert w.put(3, "c") == [(1, [(0, "b"), (7, "c")])]  # leaves least room
    assert w.put(5, "d") is None and len(w.gaps) == 2
    assert w.put(6, "e") == [(0, [(0, "a")])]  # none fits: the fullest goes
    assert w.put(10, "f") == [(3, [(0, "e")]), (4, [(0, "f")])] or len(w.gaps) <= 2


def test_empty_table(documents):
    assert packing.pack(documents([(1, "x")]).where("false"), PATH).count() == 0


def test_remembered_words_stay_bounded_and_frequent_ones_stay(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "MOST_WORDS", 60)
    known = packing.WordIds(PATH)
    for n in range(200):
        text = f"always {ODD if n % 50 == 0 else ''} Word{chr(97 + n % 26)}{'xyzq'[n % 4] * (n // 20 + 1)}***, été{'aeiou'[n % 5] * (n // 30)}&&& {n}"
        check(known, tokenizer, text)
        held = sum(len(d) for d in (known, *vars(known).values()) if isinstance(d, dict))
        assert held <= 2 * (60 + 120)
        assert b"always" in known or b"always" in known.older


def test_a_word_of_small_letters_is_remembered_once(tokenizer):
    known = packing.WordIds(PATH)
    check(known, tokenizer, " ".join(a + b + "ing" for a in "bcdfg" for b in "aeiou"))
    assert sum(len(d) for d in (known, *vars(known).values()) if isinstance(d, dict)) == 25
