"""One query per operator, with production parameters, over the whole given tables."""

from __future__ import annotations

import public_tokenizers

from rowtide.llm import collocations, exact, lines, mixing, ngram_join, packing, prefix_trie, quality, secrets, sharding, token_counts, toxicity, urls
from rowtide.llm.tables import stored


#: The tokenizers' files, at the same place on every machine.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark, sf_dir):
    return lines.removed_lines(_table(spark, sf_dir, "documents"))


def op2_sharding(spark, sf_dir):
    return sharding.shard_documents(_table(spark, sf_dir, "documents"), shards=8, seed=17)


#: Target weights of the mix; all other sources together form one stream.
WEIGHTS = {"src0": 4, "src1": 3, "src2": 2, mixing.REST: 11}


def op3_mixing(spark, sf_dir):
    return mixing.mix(_table(spark, sf_dir, "documents"), WEIGHTS, block_rows=32, seed=11)


def op4_secret_scans(spark, sf_dir):
    return secrets.find_secrets(_table(spark, sf_dir, "documents"), least_novelty=0.62)


def op5_toxicity(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.train(docs, toxicity.label_grades(_table(spark, sf_dir, "labels")), most_labels=16_000)
    return toxicity.score(docs, model)


def op6_ngram_jaccard_join(spark, sf_dir):
    return ngram_join.near_classes(_table(spark, sf_dir, "documents"))


def op7_quality_rules(spark, sf_dir):
    counts = stored(quality.text_statistics(_table(spark, sf_dir, "documents")), "statistics")
    rules = quality.rules_from_labels(counts, quality.labelled_sample(_table(spark, sf_dir, "labels"), most_labels=20_000))
    judged = quality.judge(counts, rules)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


def op8_exact_dedup(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return exact.exact_classes(docs, carry={"text_sha256": exact.full_hash()})


def op9_packing(spark, sf_dir):
    return packing.pack(_table(spark, sf_dir, "documents"), TOKENIZER, end_id=2, room=4096)


def op10_url_filters(spark, sf_dir):
    return urls.judge_urls(_table(spark, sf_dir, "pages"), urls.labelled_urls(spark))


def op11_phrase_collocations(spark, sf_dir):
    return collocations.collocations(_table(spark, sf_dir, "documents"), most_words=3, least=10, most=2000)


def op12_prefix_trie(spark, sf_dir):
    turns = prefix_trie.ordered_turns(_table(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(*prefix_trie.shared_openings(turns, period=20, openings=4))


def op13_token_counts(spark, sf_dir):
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), PIECES, limit=4096)


_ALL = (
    op1_line_dedup,
    op2_sharding,
    op3_mixing,
    op4_secret_scans,
    op5_toxicity,
    op6_ngram_jaccard_join,
    op7_quality_rules,
    op8_exact_dedup,
    op9_packing,
    op10_url_filters,
    op11_phrase_collocations,
    op12_prefix_trie,
    op13_token_counts,
)
QUERIES = {f.__name__: f for f in _ALL}

SQL = {
    "op8_exact_dedup": """with d as (select doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) as text_sha256
        from documents)
      select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size, doc_id = max(doc_id) over w as kept, text_sha256
      from d window w as (partition by text_sha256)""",
    "op11_phrase_collocations": r"""with pieces as (
        select coalesce(lang, 'und') as lang,
          unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
        from documents),
      w as (select lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') as ws from pieces),
      sizes as (select unnest([1, 2, 3]) as k),
      grams as (select lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) as phrase from w, sizes),
      every as (select lang, k, phrase, count(*) as f from grams group by all),
      totals as (select lang, cast(sum(f) as bigint) as n from every where k = 1 group by lang),
      c as (select lang, k, phrase, f, string_split(phrase, ' ') as ws from every where f >= 10),
      cuts as (select lang, phrase, k, f as a, j, array_to_string(ws[1:j], ' ') as lp, array_to_string(ws[j + 1:k], ' ') as rp
        from (select *, unnest(range(1, k)) as j from c where k > 1)),
      scores as (select q.lang, q.phrase, q.k, q.a, q.j, x.f as l, y.f as r,
          cast((1000000::hugeint * q.a * q.a) // (x.f::hugeint * y.f) as bigint) as score
        from cuts q join c x on x.lang = q.lang and x.phrase = q.lp join c y on y.lang = q.lang and y.phrase = q.rp),
      best as (select * from scores qualify row_number() over (partition by lang, phrase order by score, j) = 1),
      inside as (select lang, sub, max(f) as longest from (select lang, f, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) as sub
        from c where k = 3) group by all),
      kept as (select b.* from best b left join inside i on i.lang = b.lang and i.sub = b.phrase where i.longest is null or 100 * i.longest < 50 * b.a),
      ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
      select k.lang, k.rank, k.phrase, k.a, k.l, k.r, t.n, k.score from ranked k join totals t on t.lang = k.lang where k.rank <= 2000""",
}
