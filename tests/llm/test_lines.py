import random
import re
from collections import Counter

from rowtide.llm import lines


def expected(rows):
    """Decisions by comparing every line with all earlier ones."""
    every = []
    for d, t in rows:
        every += [((d, i), frozenset(w for w in re.split(r"[ \t\r\v\f]+", x.lower()) if w)) for i, x in enumerate((t or "").split("\n"))]
    every.sort(key=lambda e: (e[0][0] is not None, e[0][0] or 0, e[0][1]))
    out = {}
    for at, (place, words) in enumerate(every):
        out[place] = bool(words) and any(100 * len(words & w) >= 80 * len(words | w) for p, w in every[:at] if w and p != place)
    return out


def decided(docs):
    return {(r.doc_id, r.line_no): r.removed for r in lines.line_decisions(docs).collect()}


def test_random_lines_with_near_copies(documents):
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    base = [[rnd.choice(words) for _ in range(rnd.randint(1, 25))] for _ in range(25)]
    rows = []
    for d in range(40):
        text = []
        for _ in range(6):
            line = list(rnd.choice(base))
            if rnd.random() < 0.6:
                line[rnd.randrange(len(line))] = rnd.choice(words)
            text.append(" ".join(line))
        rows.append((d, "\n".join(text)))
    assert decided(documents(rows)) == expected(rows)


def test_large_group_of_near_copies_and_a_hot_line(documents):
    words = [f"t{i}" for i in range(30)]
    rows = [(i, "The very common line of all\n" + " ".join(words[:29] + [f"own{i}"])) for i in range(250)]
    got = decided(documents(rows))
    assert [k for k, gone in got.items() if not gone] == [(0, 0), (0, 1)] or {k for k, gone in got.items() if not gone} == {(0, 0), (0, 1)}


def test_odd_rows(documents, odd_rows):
    rows = [r for r in odd_rows if r[0] != 9] + [(9, "Two words"), (12, "a b c d\ta\ra b"), (13, "d c b a"), (14, "a b c d e"), (15, "\n\n")]
    rows = [r for r in rows if r[0] is not None] + [(None, "a row without an id that has some words in it")]
    assert decided(documents(rows)) == expected(rows)


def test_cut_texts(documents):
    docs = documents([(1, "keep me here now\n\nkeep me here now"), (2, "Keep me here now\nother words in this"), (3, None), (3, None)])
    got = lines.without_lines(docs, lines.line_decisions(docs))
    assert got.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter(
        [(1, "keep me here now\n"), (2, "other words in this"), (3, None), (3, None)]
    )
    found = {r.doc_id: (r.n_lines, r.n_removed, r.removed) for r in lines.removed_lines(docs).collect()}
    assert found == {1: (3, 1, "2"), 2: (2, 1, "0"), 3: (1, 0, "")}


def test_empty_table(documents):
    none = documents([(1, "x")]).where("false")
    assert lines.line_decisions(none).count() == lines.removed_lines(none).count() == 0


def test_stored_tables_have_no_more_rows_than_there_are_lines(documents, monkeypatch):
    """Word lists of lines are many times the lines; none is written out."""
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    rows = [(d, "\n".join(" ".join(rnd.choices(words, k=40)) for _ in range(5))) for d in range(30)]
    held, written = {}, lines.stored
    monkeypatch.setattr(lines, "stored", lambda df, label: held.setdefault(label, written(df, label)))
    assert decided(documents(rows)) == expected(rows)
    assert max(df.count() for df in held.values()) <= 150


def test_long_lines_around_the_least_similarity(documents):
    rnd = random.Random(8)
    words = [f"w{i}" for i in range(2000)]
    rows = []
    for d in range(12):
        base = rnd.sample(words, rnd.choice([20, 63, 64, 127, 130, 200, 260]))
        text = []
        for share in (0.0, 0.05, 0.1, 0.105, 0.11, 0.111, 0.112, 0.12, 0.15):
            line = list(base)
            for at in rnd.sample(range(len(line)), round(share * len(line))):
                line[at] = rnd.choice(words) if rnd.random() < 0.8 else ""
            text.append(" ".join(line))
        rnd.shuffle(text)
        rows.append((d, "\n".join(text)))
    want = expected(rows)
    assert 20 < sum(want.values()) < 100
    assert decided(documents(rows)) == want


def test_long_list_of_a_frequent_word_with_near_copies(documents):
    rnd = random.Random(9)
    base = [f"t{i}" for i in range(14)]
    rows = [(i, " ".join([w if rnd.random() < 0.95 else f"x{rnd.randrange(3)}" for w in base])) for i in range(400)]
    assert decided(documents(rows)) == expected(rows)


def test_rows_repeating_id_and_text_and_null_ids(documents):
    line = "a line of ten words that is told once only"
    rows = [(1, line + "\nother words here at all"), (2, line + " more"), (3, "x")]
    once = decided(documents(rows))
    assert once == expected(rows) and once[2, 0]
    assert decided(documents(rows * 3)) == once
    nulls = [(None, " ".join(f"n{i}w{j}" for j in range(9))) for i in range(5)]
    assert decided(documents([*nulls, (4, nulls[3][1] + " more")])) == {(None, 0): False, (4, 0): True}
