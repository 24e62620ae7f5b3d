"""The core queries stay whatever else is installed."""

import sys
import warnings

import __spark_entry__


def test_a_missing_library_of_the_text_operators_leaves_the_rest(monkeypatch):
    for name in [m for m in sys.modules if m == "corpus_pipeline" or m.startswith("rowtide.llm")]:
        monkeypatch.delitem(sys.modules, name)
    for name in ("zstandard", "tokenizers", "sentencepiece", "public_tokenizers"):
        monkeypatch.setitem(sys.modules, name, None)
    with warnings.catch_warnings(record=True):
        warnings.simplefilter("always")
        names, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert "apply_changes" in names and set(sql) <= set(names) and not any(n.startswith("op") and "_" in n and n[2:3].isdigit() for n in names)
