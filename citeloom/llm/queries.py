"""The queries of the training-data operators, over the tables of a folder."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.llm import alignment, byte_bpe, chat, fingerprints, hard_negatives, language, packing, quality, warc
from citeloom.llm import exact_dedup as exact
from citeloom.llm import near_dedup as near
from citeloom.llm import suffix_dedup as suffix
from citeloom.llm import token_counts as counts
from citeloom.llm.common import held_out, table_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the rank file has the vocabulary of byte_bpe_50k.json without its added tokens; with them it gives the same ids
    ranks, added = public_tokenizers.path("byte_bpe_50k.tiktoken"), packing.added_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, capacity=1024, end_id=2, added=added)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.round_trip(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return counts.token_counts(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    spans = language.label_spans(docs, language.train(docs))
    return spans.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return quality.score_quality(docs, quality.train(docs, labels), cutoff=0.7)


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(_table(spark, sf_dir, "documents"))


def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(_table(spark, sf_dir, "documents"))


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    trap = r"\### Assistant: </turn> ok"
    extra = f"values (-7L, 0L, 'user', r'{trap}'), (-7L, 1L, 'assistant', r'{trap}')"
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.conversation_digests(chat.chat_windows(turns.union(spark.sql(f"select * from {extra} as t(conv_id, turn, role, text)"))))


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_dedup(_table(spark, sf_dir, "documents"), per_cent=85)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_dedup(_table(spark, sf_dir, "documents")).drop("n_chars")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hard_negatives.usable(_table(spark, sf_dir, "embeddings"), "vec_id", "label", "embedding", scale=256)
    moved = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved), F.col("id") % 50 == 0, positives=5, negatives=3, least_per_cent=50, most_per_cent=95)


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the rank file has the vocabulary of byte_bpe_50k.json without its added token, whose string is plain text here
    ranks, model = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.link_statistics(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, model)


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = table_path(spark, "warc")
    warc.write_archives(_table(spark, sf_dir, "pages"), path, least_bytes=0)
    return warc.read_archives(spark, path, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP11_SQL = """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select a.vec_id as anchor_id, c.vec_id as other, a.label = c.label as same, list_dot_product(a.v, c.v)::bigint as score
  from v a join v c on a.vec_id <> c.vec_id where a.vec_id % 50 = 0),
p as (select anchor_id, other as positive_id, score as positive_score from s where same qualify row_number() over (partition by anchor_id order by score desc, other) <= 5)
select anchor_id, positive_id, (row_number() over (partition by anchor_id, positive_id order by score desc, other))::int as rank, other as negative_id, positive_score, score as negative_score
from p join s using (anchor_id) where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
qualify row_number() over (partition by anchor_id, positive_id order by score desc, other) <= 3
"""


OP13_SQL = """
with h as (select page_id, coalesce(html, '') as t from pages),
b as (
  select page_id, t, array_to_string(list_transform(string_split(sha1(t), ''), lambda c: ['0000', '0001', '0010', '0011', '0100', '0101', '0110', '0111', '1000', '1001', '1010', '1011', '1100', '1101', '1110', '1111'][strpos('0123456789abcdef', c)]), '') as bits,
         max(page_id) over (partition by t) as last
  from h)
select page_id, strlen(t)::bigint as payload_bytes, case when page_id = last then 'response' else 'revisit' end as record_type, case when page_id <> last then last end as refers_to,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum(list_transform(range(5), lambda k: substr(bits, 5 * i + k + 1, 1)::int * (16 >> k)))::int, 1)), '') as payload_digest
from b
"""


OP10_SQL = r"""
with d as (
  select doc_id, length(coalesce(text, '')) as n_chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as text_sha256
  from documents),
r as (
  select doc_id, text_sha256, count(*) over (partition by text_sha256) as group_size,
         first_value(doc_id) over (partition by text_sha256 order by n_chars desc, doc_id) as keep_id
  from d)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256 from r
"""


OP6_SQL = r"""
with recursive w as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws
  from documents),
s as (
  select doc_id, case when len(ws) >= 5 then list_distinct([array_to_string(ws[i:i + 4], ' ') for i in range(1, len(ws) - 3)])
                      when len(ws) > 0 then [array_to_string(ws, ' ')] else [] end as sh
  from w),
e as (select doc_id, unnest(sh) as g from s),
p as (select a.doc_id as a, b.doc_id as b, count(*) as c from e a join e b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
l as (select a, b from p join s x on x.doc_id = a join s y on y.doc_id = b where 100 * c >= 85 * (len(x.sh) + len(y.sh) - c)),
ends as (select a, b from l union select b, a from l),
r as (select doc_id as d, doc_id as t from s union select r.d, ends.b from r join ends on r.t = ends.a),
m as (select d, min(t) as component_id from r group by d)
select doc_id, len(sh)::bigint as n_shingles, component_id, doc_id = component_id as kept from s join m on d = doc_id
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_best_fit_packing": op1_best_fit_packing,
        "op4_byte_bpe": op4_byte_bpe,
        "op8_token_counts": op8_token_counts,
        "op5_language_id": op5_language_id,
        "op7_quality_classifier": op7_quality_classifier,
        "op2_suffix_array_dedup": op2_suffix_array_dedup,
        "op3_document_fingerprints": op3_document_fingerprints,
        "op9_chat_formatting": op9_chat_formatting,
        "op6_minhash_near_dedup": op6_minhash_near_dedup,
        "op10_exact_dedup": op10_exact_dedup,
        "op11_hard_negatives": op11_hard_negatives,
        "op12_tokenizer_alignment": op12_tokenizer_alignment,
        "op13_warc": op13_warc,
    }


def oracle_sql() -> dict[str, str]:
    return {"op6_minhash_near_dedup": OP6_SQL, "op10_exact_dedup": OP10_SQL, "op11_hard_negatives": OP11_SQL, "op13_warc": OP13_SQL}
