"""The queries of this package, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runledger.llm.lattice import vector_classes
from runledger.llm.mixing import mix, word_count
from runledger.llm.near_dedup import document_classes
from runledger.llm.packing import pack_documents
from runledger.llm import pii, secrets, toxicity
from runledger.llm.prefix_trie import conversation_trie
from runledger.llm.quality_rules import COUNTS, judge, learn_rules
from runledger.llm.spans import count_of, span_text
from runledger.llm.substring import without_repeats
from runledger.llm.token_alignment import align_documents
from runledger.llm.top_products import scaled, top_products
from runledger.llm.url_filter import judged_urls
from runledger.plans.registered import Registered
from runledger.sources.tables import read_table


def op1_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    return pack_documents(docs, str(public_tokenizers.path("byte_bpe_50k.json")))


def op2_learned_decision_lists(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    rules = learn_rules(docs, read_table(spark, folder, "labels"))
    return judge(docs, rules).select("doc_id", *COUNTS, "base_failed", "kept", "rule")


def op3_order_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    return document_classes(docs).select("doc_id", "component_id", "kept")


#: The rules of the registered query.
URL_RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)

URL_ORACLE = """
with parts as (
  select page_id, coalesce(regexp_extract(url, '(?s)^.*?://(.*)$', 1), '') as rest from pages
), hosts as (
  select page_id, rest, regexp_extract(rest, '^[^/?#]*') as raw from parts
), places as (
  select page_id,
    translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') as path
  from hosts
), rules(r_host, r_path, r_verdict) as (
  values ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
    ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), fits as (
  select page_id, arg_max(r_host || r_path, length(r_host || r_path)) as rule,
    arg_max(r_verdict, length(r_host || r_path)) as verdict
  from places join rules on (host = r_host or ends_with(host, '.' || r_host)) and starts_with(path, r_path)
  group by page_id
)
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict
from places left join fits using (page_id)
"""


def op4_url_trie(spark: SparkSession, folder: str) -> DataFrame:
    pages = read_table(spark, folder, "pages").select("page_id", "url")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judged_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op5_e8_lattice_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return vector_classes(read_table(spark, folder, "embeddings"))


def op6_entropy_balancing(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "source", "text")
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("words"))
    return mix(sized, size=F.col("words")).select("doc_id", "size", "source_size", "target", "taken")


def op7_ordinal_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.train(docs, read_table(spark, folder, "labels"))
    scored = toxicity.with_severity(docs, model)
    return scored.select("doc_id", "severity", "grade", (F.col("grade") > model.grades[0]).alias("toxic"))


def op8_fixed_block_substrings(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    return without_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op10_skip_chain_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    found = pii.with_spans(docs, pii.train(docs))
    return _span_digest(found, pii.KINDS)


def op9_inferred_secret_formats(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    found = secrets.with_spans(docs, secrets.train(docs))
    return _span_digest(found, secrets.KINDS[:3])


def op11_distinct_text_alignment(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    vocabularies = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return align_documents(docs, *map(str, vocabularies))


TOP_ORACLE = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scores as (
  select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.v, c.v) as bigint) as score
  from v q join v c on q.vec_id % 50 = 0 and c.vec_id <> q.vec_id
), ranked as (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as nth from scores
)
select query_id, cast(nth as int) as rank, vec_id, score from ranked where nth <= 5
"""


def op12_norm_bucketed_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = read_table(spark, folder, "embeddings")
    whole = vectors.select("vec_id", scaled(F.col("embedding"), 256.0).alias("vector"))
    return top_products(whole, F.col("vec_id") % 50 == 0, k=5)


#: The first h turns of conversation c - c % 20, h = CRC-32 of c's digits % 4, then c's own; nodes are
#: lists of turns, and a node lies below another if it begins with it.
TRIE_ORACLE = r"""
with own as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
    row_number() over (partition by conv_id order by turn nulls first) - 1 as pos
  from conversations where conv_id is not null
), convs as (
  select conv_id, count(*) as n, xor(list_reduce(
      list_concat([4294967295::bigint], list_transform(string_split(conv_id::varchar, ''), lambda d: ascii(d)::bigint)),
      lambda crc, byte: list_reduce(
        list_concat([xor(crc, byte)], [0::bigint, 0, 0, 0, 0, 0, 0, 0]),
        lambda x, _: case when x % 2 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)
    ), 4294967295) % 4 as h
  from own group by conv_id
), rebuilt as (
  select c.conv_id, 0 as part, b.pos, b.role, b.text
  from convs c join own b on b.conv_id = c.conv_id - c.conv_id % 20 and b.pos < c.h
  union all
  select c.conv_id, 1, o.pos, o.role, o.text from convs c join own o on o.conv_id = c.conv_id and o.pos >= c.h
), whole as (
  select c.conv_id, coalesce(list({'role': role, 'text': text} order by part, pos) filter (where r.conv_id is not null), []) as turns
  from convs c left join rebuilt r on r.conv_id = c.conv_id group by c.conv_id
), members as (
  select conv_id, len(turns) as size, unnest(range(0, len(turns) + 1)) as depth, turns from whole
), nodes as (
  select depth, turns[1:depth] as node, min(conv_id) as conv_id, count(*) as n_convs,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where size = depth), '')) as ends_sha256
  from members group by 1, 2
), measured as (
  select *, (select count(*) from nodes c where c.depth = n.depth + 1 and c.node[1:n.depth] = n.node) as n_children,
    case when depth = 0 then 0 else (n_convs - 1) * len(list_filter(
      string_split_regex(node[depth].text, '[\x20\x09-\x0D]+'), lambda w: w <> '')) end as saved
  from nodes n
)
select m.conv_id, cast(m.depth as bigint) as depth, p.conv_id as parent_conv_id, m.n_convs, m.n_children,
  (select count(*) from measured b where b.n_children = 0 and b.depth >= m.depth and b.node[1:m.depth] = m.node) as n_leaves,
  (select cast(sum(b.saved) as bigint) from measured b where b.depth >= m.depth and b.node[1:m.depth] = m.node) as saved_tokens,
  m.ends_sha256
from measured m left join nodes p on p.depth = m.depth - 1 and p.node = m.node[1:m.depth - 1]
"""


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_trie(read_table(spark, folder, "conversations"))


def _span_digest(found: DataFrame, base_kinds: tuple[str, ...]) -> DataFrame:
    counts = [count_of("base_spans", kind).alias(f"n_{kind}") for kind in base_kinds]
    base = F.sha2(span_text("base_spans"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, base, span_text("all_spans").alias("spans"))


LLM_QUERIES: dict[str, Registered] = {
    "op1_best_fit_packing": Registered(op1_best_fit_packing),
    "op2_learned_decision_lists": Registered(op2_learned_decision_lists),
    "op3_order_minhash_near_dedup": Registered(op3_order_minhash_near_dedup),
    "op4_url_trie": Registered(op4_url_trie, URL_ORACLE),
    "op5_e8_lattice_near_dedup": Registered(op5_e8_lattice_near_dedup),
    "op6_entropy_balancing": Registered(op6_entropy_balancing),
    "op7_ordinal_toxicity": Registered(op7_ordinal_toxicity),
    "op8_fixed_block_substrings": Registered(op8_fixed_block_substrings),
    "op9_inferred_secret_formats": Registered(op9_inferred_secret_formats),
    "op10_skip_chain_pii": Registered(op10_skip_chain_pii),
    "op11_distinct_text_alignment": Registered(op11_distinct_text_alignment),
    "op12_norm_bucketed_top_k": Registered(op12_norm_bucketed_top_k, TOP_ORACLE),
    "op13_prefix_trie": Registered(op13_prefix_trie, TRIE_ORACLE),
}
