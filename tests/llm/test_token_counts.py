import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor

from rowtide.llm import token_counts as tc

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = SentencePieceProcessor(model_file=PATH)
ODD = [" ", "  ", " a", "a ", "a  b", "▁", "▁▁a ▁ b▁", "<s> </s> <unk>", "a\n b\n\n  c\t d", "\x00 x", "日本語 テキスト", "\U0001f600 \U0001f600", "x" * 5000, " " * 300 + "y", "a b　c"]


def expected(rows):
    return sorted(((i, len((t or "").encode()), n, n > 40) for i, t in rows for n in [len(MODEL.encode(t or ""))]), key=repr)


@settings(max_examples=400, deadline=None)
@given(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from(" ▁\n\tab<s>/")), max_size=40))
def test_parts_have_the_texts_tokens(text):
    e = tc.encoder(PATH)
    assert sum(e.lengths(tc.pretokens(text))) == len(MODEL.encode(text))


def test_counts_equal_the_librarys(documents, odd_rows, rows):
    words = ["the", "quick", "été", "naïve", "zzzqx", "日本", "a,b.", "12345"]
    rng = random.Random(3)
    texts = odd_rows + [(100 + i, t) for i, t in enumerate(ODD)]
    texts += [(1000 + i, " ".join(rng.choices(words, k=i % 60))) for i in range(200)]
    got = tc.count_tokens(documents(texts, parts=40), PATH, limit=40, most_frequent=4)
    assert rows(got) == expected(texts)


def test_all_documents(spark, rows):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = tc.count_tokens(docs, PATH, limit=40)
    assert rows(got) == expected([tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_a_model_whose_pieces_may_cross_spaces_encodes_whole_texts(documents, odd_rows, rows, monkeypatch):
    monkeypatch.setattr(tc.Encoder, "parts_suffice", lambda self: False)
    assert rows(tc.count_tokens(documents(odd_rows), PATH, limit=40)) == expected(odd_rows)


def test_worker_cache_stays_bounded():
    cache = tc.Lengths(PATH, most=3)
    for k in range(10):
        found = cache.learn([f"w{k}", "x" * 100])
        assert found == {f"w{k}": len(MODEL.encode(f"w{k}")), "x" * 100: len(MODEL.encode("x" * 100))}
        assert len(cache) <= 3 and "x" * 100 not in cache


def test_frequent_parts_and_their_table(documents):
    texts = documents([(i, "the cat  sat " + f"rare{i}") for i in range(50)], parts=40).select("text")
    parts = tc.frequent_pretokens(texts, most=3)
    assert parts == [" sat", "cat", "the"]
    assert tc.FrequentTable(parts, [5, 6, 7]).table() == {" sat": 5, "cat": 6, "the": 7}


def test_empty_table(documents):
    assert tc.count_tokens(documents([(1, "x")]).where("false"), PATH).count() == 0


def test_no_shuffle(documents, capsys):
    tc.count_tokens(documents([(1, "x y")]).coalesce(2), PATH).explain()
    assert "hashpartitioning" not in capsys.readouterr().out


@pytest.mark.parametrize("most", [0, 1])
def test_small_first_tier(documents, rows, most):
    texts = [(1, "a b a"), (2, None)]
    assert rows(tc.count_tokens(documents(texts), PATH, 40, most_frequent=most)) == expected(texts)
