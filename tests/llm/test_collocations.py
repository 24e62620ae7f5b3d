import random
import re
from collections import Counter, defaultdict

import pytest

from rowtide.llm import collocations as co

SCHEMA = "doc_id long, text string, lang string, n string, phrase string, score string, size string"


def pieces(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", lowered)]


def brute(rows, most_words=3, least=10, percent=50, most=2000):
    counts, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        for ws in pieces(text):
            n[lang or "und"] += len(ws)
            for k in range(1, most_words + 1):
                counts[lang or "und"].update(tuple(ws[i : i + k]) for i in range(len(ws) - k + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        best, longer = [], Counter()
        for q, b in candidates.items():
            for part in {q[i:j] for i in range(len(q)) for j in range(i + 2, len(q) + 1)} - {q}:
                longer[part] = max(longer[part], b)
        for p, a in candidates.items():
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            if p not in longer or 100 * longer[p] < percent * a:
                best.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(best)[:most], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out, key=repr)


@pytest.fixture
def table(spark):
    def make(rows, parts=3):
        return spark.createDataFrame([(i, t, lang, "a", "b", "c", "d") for i, (lang, t) in enumerate(rows)], SCHEMA).repartition(parts)

    return make


def texts(seed, n=200, vocabulary=30, marks=" ,  .\t\n;"):
    rng = random.Random(seed)
    words = [f"W{i}" for i in range(vocabulary)] + ["é", "DER", "\x1c", "a b"]
    return [(rng.choice(["en", "de", None]), "".join(rng.choice(words) + rng.choice(marks) for _ in range(rng.randint(0, 60)))) for _ in range(n)]


@pytest.mark.parametrize(("most_words", "least", "modulus"), [(3, 10, 16), (2, 4, 3), (4, 3, 5), (3, 2, 1)])
def test_against_brute_force(table, rows, most_words, least, modulus):
    data = texts(most_words) + texts(9, n=40, vocabulary=2)
    got = co.collocations(table(data), most_words, least, modulus=modulus)
    assert rows(got) == brute(data, most_words, least)


def test_odd_rows(table, rows, odd_rows):
    data = [("en", t) for _, t in odd_rows] * 6 + [("x", "a b " * 40_000), ("x", "same"), (None, "no lang here"), ("und", "no lang here")] * 5
    data += [("en", "tie one. tie one. one two. one two")] * 10 + [("zz", "..;;\n\n"), ("qq", None)]
    for parts in (1, 7):
        assert rows(co.collocations(table(data, parts))) == brute(data)


def test_first_rows_and_their_order(table, rows):
    data = texts(5, vocabulary=12)
    got = co.collocations(table(data), least=2, most=7)
    assert rows(got) == brute(data, least=2, most=7)
    assert {r.rank for r in got.collect()} == set(range(1, 8))


def test_empty_table(table):
    assert co.collocations(table([("en", "a b")]).where("false")).count() == 0


def test_chunks_own_every_word_once():
    data = co.marked_words(b"One, two three. " * 50 + b"x y " * 300)
    words = data.split(b" ")
    for reach in (1, 2, 3):
        parts = list(co.chunks(data, reach, modulus=4, longest=20))
        assert sum(own for _, own in parts) == len(words)
        assert [w for text, own in parts for w in text.split(b" ")[:own]] == words
        assert all(len(t.split(b" ")) <= own + reach for t, own in parts)


def test_copies_share_their_chunks(table):
    body = " ".join(f"w{i}" for i in range(400))
    alone = co.dictionary(table([("en", body)])).count()
    many = co.dictionary(table([("en", f"{p} {body}") for p in ("a", "b c", "d e f", "")] * 20)).agg({"n": "max", "*": "count"}).first()
    assert many["count(1)"] <= alone + 8 and many["max(n)"] == 80


def test_scores_are_exact_beyond_64_bits(spark):
    for a, left, right in [(10**13 + 7, 10**13 + 9, 10**14 + 1), (3, 3, 3), (999_999_999_999_999, 10**15, 10**15), (10, 999_983, 12_345)]:
        row = spark.createDataFrame([(a, left, right)], "a long, l long, r long")
        assert row.select(co.exact_score()).first()[0] == 1_000_000 * a * a // (left * right)


def test_word_table():
    words = [b"a", b".", b"ab", b"a", "été".encode(), b"\x00", b"\x00\x00", b"x" * 300, b"ab", b"ba"]
    starts, ends, hashes = co.word_table(b" ".join(words))
    data = b" ".join(words)
    assert [data[s:e] for s, e in zip(starts, ends)] == words
    assert len(set(hashes.tolist())) == len(set(words)) and hashes[0] == hashes[3] and hashes[2] == hashes[8]
    many = [str(k * k).encode() for k in range(50_000)]
    assert len(set(co.word_table(b" ".join(many))[2].tolist())) == len(set(many))


def test_many_words_in_phrases_of_many_words(table, rows):
    rng = random.Random(8)
    data = [("en", " ".join(f"w{rng.randrange(6000)}" for _ in range(300)) + " one two three four five six") for _ in range(40)]
    assert rows(co.collocations(table(data), most_words=5, least=8)) == brute(data, most_words=5, least=8)
