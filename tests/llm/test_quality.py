import random
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from rowtide.llm import quality


def counted(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    runs = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = {i + k for i in range(len(words) - 4) if runs[tuple(words[i : i + 5])] > 1 for k in range(5)}
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), again, len(inside)


@given(st.text(alphabet="ab é#|\n\t\x0b<ß", max_size=200))
@settings(max_examples=300, deadline=None)
def test_counts(text):
    assert quality.text_counts(text)[:5] == counted(text)


def test_statistics_of_odd_rows(documents, odd_rows):
    got = quality.text_statistics(documents(odd_rows)).collect()
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == Counter(
        (i, *counted(t)) for i, t in odd_rows
    )


def test_rules_find_what_marks_bad_rows():
    rnd = np.random.default_rng(2)
    x = rnd.random((3000, 4))
    bad = ((x[:, 0] > 0.8) & (x[:, 2] <= 0.5)) | (x[:, 3] > 0.95)
    names = ("a", "b", "c", "d")
    rules = quality.learn_rules(x, bad, names)
    test = rnd.random((3000, 4))
    truth = ((test[:, 0] > 0.8) & (test[:, 2] <= 0.5)) | (test[:, 3] > 0.95)
    found = np.any([r.covers(test, names) for r in rules], axis=0)
    assert (found & truth).sum() > 0.9 * truth.sum() and (found & ~truth).sum() < 0.01 * (~truth).sum()


def test_no_rules_without_both_kinds():
    x = np.random.default_rng(0).random((50, 2))
    assert quality.learn_rules(x, np.zeros(50, bool), ("a", "b")) == []
    assert quality.learn_rules(x, np.ones(50, bool), ("a", "b")) == []


def test_expression_agrees_with_the_rules(spark, documents):
    rnd = random.Random(4)
    rows = [(i, " ".join(rnd.choice(["alpha", "beta!", "|", "#x", "LONGWORDOFMANYLETTERS"]) for _ in range(rnd.randint(5, 40)))) for i in range(200)]
    rules = [quality.Rule((("symbol_share", ">", 0.05), ("mark_share", "<=", 0.2))), quality.Rule((("long_share", ">", 0.3),))]
    got = quality.judge(quality.text_statistics(documents(rows)), rules).toPandas()
    x = got[list(quality.RATIOS)].to_numpy(float)
    first = [r.covers(x, quality.RATIOS) for r in rules]
    fired = np.where(first[0], 1, np.where(first[1], 2, 0))
    assert (got["rule"].fillna(0).to_numpy() == fired).all()
    base = (got["n_words"] < 10) | (100 * got["n_repeat_words"] > 20 * got["n_words"])
    assert (got["base_failed"] == base).all() and (got["kept"] == (~base & (fired == 0))).all()


def test_labels_to_kept_documents(spark, documents):
    rnd = random.Random(6)
    rows = []
    for i in range(400):
        words = [rnd.choice("abcdefgh") * rnd.randint(2, 9) + str(rnd.randint(0, 99)) for _ in range(30)]
        rows.append((i, " | ".join(words) if i % 4 == 0 else " ".join(words)))
    labels = spark.createDataFrame([(i, int(i % 4 != 0), 0) for i in range(0, 400, 2)] + [(None, 0, 0), (3, None, 0), (9999, 0, 1)], "doc_id long, quality int, toxic int")
    docs = documents(rows + [(None, None), (401, "")])
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i in range(400) if i % 4}


def test_empty_tables(spark, documents):
    docs = documents([(1, "a b c d e f g h i j k l")])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.keep_good(docs, none).count() == 1
    assert quality.keep_good(docs.where("false"), none).count() == 0


def test_rules_take_one_row_a_label_where_ids_repeat(spark, documents, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "learn_rules", lambda x, bad, names, **options: seen.append(x) or [])
    words = "one two three four five six seven eight nine ten eleven twelve"
    docs = documents([(1, f"{words} w{k}") for k in range(200)] + [(2, words)])
    labels = spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, quality int")
    quality.rules_from_labels(quality.text_statistics(docs), quality.labelled_sample(labels, 10))
    assert len(seen[0]) == 2
