import random
import re
from collections import Counter

import numpy as np

from pyspark.sql import functions as F

from rowtide.llm import components, ngram_join


def shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def expected(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        ids.setdefault(find(i), []).append(d)
    smallest = {k: min((d for d in v if d is not None), default=None) for k, v in ids.items()}
    return Counter((d, len(sets[i]), smallest[find(i)]) for i, (d, _) in enumerate(rows))


def got(docs):
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.near_classes(docs).collect())


def test_edited_copies_chains_and_a_shared_passage(documents):
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    passage = [rnd.choice(words) for _ in range(60)]
    rows = []
    for g in range(6):
        text = [rnd.choice(words) for _ in range(rnd.randint(20, 160))]
        for _ in range(8):
            text = list(text)  # each a copy of the one before: chains link what is far apart
            text[rnd.randrange(len(text))] = rnd.choice(words)
            rows.append((len(rows), " ".join(text)))
    rows += [(1000 + i, " ".join(passage + [rnd.choice(words) for _ in range(rnd.randint(5, 40))])) for i in range(40)]
    rnd.shuffle(rows)
    assert got(documents(rows)) == expected(rows)


def test_large_group_of_near_copies(documents):
    base = [f"b{i}" for i in range(120)]
    rows = [(i, " ".join(base[: i % 110] + [f"own{i}"] + base[i % 110 + 1 :])) for i in range(220)]
    assert got(documents(rows)) == expected(rows)


def test_threshold_is_exact(documents):
    words = [f"v{i}" for i in range(104)]  # 100 shingles; a cut tail of 20 words leaves 80 of 100, of 21 words 79
    rows = [(1, " ".join(words)), (2, " ".join(words[:84])), (5, " ".join(words[:83])), (7, "A b c"), (8, "a B c"), (9, "a b c d")]
    assert got(documents(rows)) == expected(rows)


def test_odd_rows(documents, odd_rows):
    assert got(documents(odd_rows)) == expected(odd_rows)


def test_drop_near_keeps_one_of_each_group(documents, odd_rows):
    docs = documents(odd_rows)
    left = ngram_join.drop_near(docs)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {1, 3, 4, 5, 6, 8, 10, 11, None}


def test_drop_near_keeps_one_row_where_ids_repeat_or_lack(documents):
    texts = [" ".join(f"{g}{i}" for i in range(40)) for g in "abcdef"]
    rows = [
        (1, texts[0]), (2, texts[0] + " more"), (2, texts[1]),  # the unique text of id 2 stays
        (3, texts[2]), (3, texts[2] + " more"), (3, texts[2]), (9, texts[2] + " tail"),  # the smallest id repeats
        (None, texts[3]), (None, texts[3] + " more"), (None, texts[3]), (None, texts[4]), (8, texts[4] + " more"),
        (None, None), (None, ""), (7, texts[5]), (7, texts[5]),
    ]
    left = [(r.doc_id, (r.text or "")[:1]) for r in ngram_join.drop_near(documents(rows)).collect()]
    assert Counter(left) == Counter([(1, "a"), (2, "b"), (3, "c"), (None, "d"), (8, "e"), (None, ""), (None, ""), (7, "f")])


def test_empty_table(documents):
    none = documents([(1, "x")]).where("false")
    assert ngram_join.near_classes(none).count() == ngram_join.drop_near(none).count() == 0


def test_parity_never_parts_what_is_linked():
    rng = np.random.default_rng(3)
    rejected = 0
    for _ in range(600):
        n = int(rng.integers(1, 400))
        a = np.unique(rng.integers(0, 2**64, n, np.uint64))
        kept = a[rng.random(len(a)) < rng.choice([0.5, 0.8, 0.85, 0.9, 1.0])]
        b = np.unique(np.concatenate([kept, rng.integers(0, 2**64, int(rng.integers(0, 1 + n // 8)), np.uint64)]))
        if len(b):
            passed = ngram_join.may_link(len(a), ngram_join.parity(a), len(b), ngram_join.parity(b))
            assert passed or not ngram_join.is_linked(a, b)
            rejected += not passed
    assert rejected > 50
    a, b = (np.unique(rng.integers(0, 2**64, 500, np.uint64)) for _ in range(2))
    assert not ngram_join.may_link(500, ngram_join.parity(a), 500, ngram_join.parity(b))


def test_texts_read_again_are_one_per_class(documents, monkeypatch):
    """Rows without an id, and rows repeated whole, don't multiply."""
    read = []
    monkeypatch.setattr(ngram_join, "stored", lambda df, label, keep=ngram_join.stored: read.append((label, keep(df, label))) or read[-1][1])
    words = [f"w{i}" for i in range(80)]
    rows = [(None, " ".join(words[:k] + ["x"] + words[k:])) for k in range(1, 60)] * 2
    assert got(documents(rows)) == expected(rows)
    texts = [df.count() for label, df in read if label == "texts"]
    assert texts and max(texts) <= 59


def test_clashing_names_stay(documents):
    docs = documents([(1, "a b c d e f g h"), (2, "a b c d e f g h"), (3, "z")]).withColumns({c: F.lit(c) for c in ("_text_key", "text_key", "row", "row_id")})
    out = ngram_join.drop_near(docs)
    assert out.columns == docs.columns and sorted((r.doc_id, r._text_key, r.row) for r in out.collect()) == [(1, "_text_key", "row"), (3, "_text_key", "row")]


def test_common_order_gives_prefixes_that_meet():
    rnd = np.random.default_rng(1)
    classes = rnd.integers(0, 40, 1 << ngram_join.BITS).astype(np.uint8)
    for _ in range(50):
        a = np.unique(rnd.integers(0, 2**64, 50, dtype=np.uint64))
        b = np.unique(np.concatenate([a[:46], rnd.integers(0, 2**64, 3, dtype=np.uint64)]))
        for order in range(len(ngram_join.ORDERS)):
            assert set(ngram_join.prefix(a, classes, order)) & set(ngram_join.prefix(b, classes, order))


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 100)], "a long, b long")
    labels = {r.node: r.label for r in components.components(links).collect()}
    assert labels == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100}
