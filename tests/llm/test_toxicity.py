import random

import numpy as np
import pytest

from rowtide.llm import toxicity

BAD, WORSE = ["vile", "nasty", "rotten"], ["hateful", "wicked"]


def text(rnd, grade):
    words = [f"w{rnd.randint(0, 400)}" + rnd.choice("abc") for _ in range(rnd.randint(20, 60))]
    words = [w.replace("0", "o").translate(str.maketrans("123456789", "qrstuvxyz")) for w in words]
    for _ in range(3):
        if grade == 1:
            words[rnd.randrange(len(words))] = rnd.choice(BAD)
        if grade == 2:
            words[rnd.randrange(len(words))] = rnd.choice(BAD + WORSE * 2)
    return " ".join(words)


@pytest.fixture(scope="module")
def graded():
    rnd = random.Random(8)
    grades = [rnd.choice([0] * 6 + [1, 2]) for _ in range(1500)]
    return [(i, text(rnd, g)) for i, g in enumerate(grades)], grades


def test_held_out_grades(spark, documents, graded):
    rows, grades = graded
    labels = spark.createDataFrame([(i, int(g < 2), int(g > 0)) for i, g in enumerate(grades) if i < 1000] + [(None, 1, 1), (5000, 1, 1), (7, None, None)], "doc_id long, quality int, toxic int")
    docs = documents(rows)
    model = toxicity.train(docs, toxicity.label_grades(labels), bits=16)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    held = range(1000, 1500)
    toxic = [i for i in held if grades[i]]
    clean = [i for i in held if not grades[i]]
    assert sum(got[i].toxic for i in toxic) > 0.9 * len(toxic) and sum(got[i].toxic for i in clean) <= 0.02 * len(clean)
    mean = [np.mean([got[i].severity for i in held if grades[i] == g]) for g in range(3)]
    assert mean[0] < 0.2 < mean[1] < mean[2]


def test_cuts_are_ordered_and_chances_add_up(graded):
    rows, grades = graded
    slots = [np.array(sorted({s for w in toxicity.words_in(t) for s in toxicity.word_slots(w, 12)})) for _, t in rows]
    w, cuts = toxicity.fit_ordinal(slots, np.array(grades), 1 << 12, 3)
    assert list(cuts) == sorted(cuts)
    model = toxicity.OrdinalModel({i: float(x) for i, x in enumerate(w) if x}, list(cuts), 12)
    over = model.over(1.0)
    assert 1 >= over[0] >= over[1] >= 0


def test_odd_rows_and_no_labels(spark, documents, odd_rows):
    none = spark.createDataFrame([], "doc_id long, grade int")
    model = toxicity.train(documents(odd_rows), none, bits=10)
    got = toxicity.score(documents(odd_rows), model).collect()
    assert len(got) == len(odd_rows) and not any(r.toxic for r in got)
    assert toxicity.score(documents(odd_rows).where("false"), model).count() == 0


def test_score_is_the_sum_over_words(documents):
    model = toxicity.OrdinalModel({s: 1.0 for s in toxicity.word_slots("vile", 14)}, [1.0, 3.0], 14, 1.5)
    got = {r.doc_id: r for r in toxicity.score(documents([(1, "Vile! VILE vile_x"), (2, "fine"), (None, None)]), model).collect()}
    assert got[1].score == model.word("vile") + model.word("x") and got[1].toxic and not got[2].toxic and got[None].score == 0


def test_best_cut():
    assert toxicity.best_cut(np.array([3.0, 2.0, 1.0, 0.0]), np.array([True, True, False, False]), 9) == 1.5
    assert toxicity.best_cut(np.array([1.0, 1.0]), np.array([False, False]), 9) == 9


def test_sample_has_one_row_a_label_where_ids_repeat(spark, documents):
    docs = documents([(1, f"text {k}") for k in range(300)] + [(2, "b"), (3, None)])
    labels = spark.createDataFrame([(1, 0, 0), (2, 1, 1), (3, 1, 0)], "doc_id long, quality int, toxic int")
    sample = toxicity.graded_sample(docs, toxicity.label_grades(labels), 10).collect()
    assert len(sample) == 3 and len({r.doc_id for r in sample}) == 3
