"""The registered queries over the smallest tables, and the pipeline against brute force."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from rowtide.llm import quality, queries
from suite.compare import differences, oracle
from tests.llm.test_exact_and_shards import lowered
from tests.llm.test_ngram_join import shingles

SF = "/root/testdata/sf0.001"
#: Queries whose first column is not the id of a document.
TABLES = {"op10_url_filters": ("pages", "page_id"), "op11_phrase_collocations": ("documents", "lang"), "op12_prefix_trie": ("conversations", "conv_id")}


def test_all_are_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_agrees_with_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, SF), oracle(SF), queries.SQL[name]) == []


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_reads_all_rows(spark, name):
    table, key = TABLES.get(name, ("documents", "doc_id"))
    ids = {r[0] for r in spark.read.parquet(f"{SF}/{table}.parquet").select(key).collect()}
    got = queries.QUERIES[name](spark, SF)
    assert {r[0] for r in got.select(got.columns[0]).collect()} == ids


def test_stages(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "exact dedup", "n-gram Jaccard join", "mixing sources to target weights", "packing"]


def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = quality.keep_good(docs, spark.read.parquet(f"{SF}/labels.parquet")).select("doc_id", "text").collect()
    for r in docs.collect():  # rules learned from labels can only take more away than the base rule
        if r.doc_id in {k.doc_id for k in kept}:
            n, _, _, _, again = quality.text_counts(r.text)[:5]
            assert n >= 10 and 100 * again <= 20 * n
    groups = defaultdict(list)
    for r in kept:
        groups[lowered(r.text)].append(r.doc_id)
    left = sorted((max(ids), text) for text, ids in groups.items())
    sets = {i: shingles(t) for i, t in left}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in sets:
            both = len(sets[i] & sets[j])
            if j < i and sets[i] and 100 * both >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    stay = {i for i in sets if find(i) == i}
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in got} == stay
    tokenizer = Tokenizer.from_file(queries.TOKENIZER)
    texts = {r.doc_id: r.text for r in kept}
    tokens = Counter()
    for r in got:
        tokens[r.doc_id] += r.length
    assert tokens == Counter({i: len(tokenizer.encode(texts[i], add_special_tokens=False).ids) + 1 for i in stay})
    fill = Counter()
    for r in got:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 4096


def test_native_queries_run_no_python(spark, capsys):
    for name in ("op1_line_dedup", "op2_sharding", "op10_url_filters"):
        queries.QUERIES[name](spark, SF).explain()
        assert not re.search("Python|Arrow|Pandas", capsys.readouterr().out)


def test_word_hashes_are_those_of_whole_words():
    from rowtide.llm.words import shingle_set

    assert len(shingle_set("a b c d e f")) == 2 and len(shingle_set("A b")) == 1 and (shingle_set("A b") == shingle_set("a B")).all()
    assert len(shingle_set(None)) == len(shingle_set(" \n")) == 0
    assert np.all(np.diff(shingle_set(" ".join(map(str, range(100)))).astype(float)) >= 0)
