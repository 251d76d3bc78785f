"""The operators over the given tables with production parameters: ``op<N>_<name>``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    conversations,
    decontamination,
    extraction,
    infill,
    knn,
    language,
    mixing,
    sharding,
    simhash,
    substrings,
    suffixes,
    tokens,
    urls,
)
from tidemark.llm.common import hex64
from tidemark.session import new_folder, stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql:
            SQL[name] = sql
        return function

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


@query("op8_simhash_near_dedup")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    groups = simhash.simhash_groups(table(spark, folder, "documents"), shingle=3, distance=3)
    return groups.select("doc_id", hex64(groups.fingerprint).alias("fingerprint"), "component_id")


OP3_SQL = r"""
with texts as (
  select row_number() over () as n, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents
), places as (
  select n, unnest(range(1, len(words) + 1)) as i, unnest(words) as word, len(words) as size, words from texts
), windows as (
  select n, i, word, case when i + 34 <= size then hash(array_to_string(words[i : i + 34], chr(32))) end as win from places
), counted as (
  select n, i, word, win is not null and count(*) over (partition by win) > 1 as repeated from windows
), covered as (
  select n, i, word, bool_or(repeated) over (partition by n order by i rows between 34 preceding and current row) as gone from counted
), kept as (
  select n, count(*) filter (where gone) as n_removed, string_agg(word, ' ' order by i) filter (where not gone) as kept
  from covered group by n
)
select doc_id, len(words)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from texts left join kept using (n)
"""


@query("op3_substring_dedup", OP3_SQL)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    found = substrings.remove_repeated_passages(table(spark, folder, "documents"), length=35)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op5_suffix_array_dedup")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    found = suffixes.remove_earlier_strings(table(spark, folder, "documents"), length=50)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op1_sharding")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    digests = table(spark, folder, "documents").select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    units = stored(sharding.copies_in_blocks(digests, ["doc_id", "size", "text_crc32"], block=16), "units")
    weight = F.col("size") * F.col("copies")
    placed = units.withColumn("virtual_slot", sharding.virtual_slot(F.col("doc_id"), F.col("text_crc32"), F.col("block")))
    maps = new_folder(spark, "slot-map")
    totals = sharding.slot_bytes(placed.select("virtual_slot", weight.alias("size")))
    sharding.store_map(sharding.new_map(totals, 24), maps)
    slot_map = sharding.load_map(spark, maps)
    numbered = sharding.number_in_shard(placed, slot_map, ["doc_id", "size", "text_crc32", "block"])
    rows = numbered.withColumn("copy", F.explode(F.sequence(F.lit(0), (F.col("copies") - 1).cast("int"))))
    return rows.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        sharding.shard_of(F.col("virtual_slot"), slot_map).alias("shard"),
        (F.col("first") + F.col("copy")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
    )


OP6_SQL = r"""
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size
  from documents
), numbered as (
  select *, (row_number() over (partition by doc_id, source, size) - 1) // 64 as block from sized
), hashed as (
  select *, ('0x' || left(md5(coalesce('=' || doc_id, '') || '|=' || size || '|=' || block), 15))::bigint as h from numbered
), sources as (
  select source, sum(size)::bigint as source_size from sized group by source
), weighed as (
  select *, [5, 2, 1][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::double as w from sources
), filled as (
  select *, sum(source_size) over ()::double * 1.5::double as everything,
    coalesce(sum(source_size) over (order by source_size / w, source nulls last
      rows between unbounded preceding and 1 preceding), 0)::double as capped,
    sum(w) over (order by source_size / w, source nulls last
      rows between current row and unbounded following) as rest
  from weighed
), leveled as (
  select *, (everything - 2 * capped) / rest as each from filled
), aims as (
  select source, source_size, coalesce(least(
      (select arg_min(each, capped) from leveled where source_size * 2 > each * w) * w,
      (source_size * 2)::double), (source_size * 2)::double) as target
  from leveled
), rounds as (
  select *, case when source_size > 0 then floor(target / source_size)::bigint else 0 end as rounds from aims
), sums as (
  select h.*, r.source_size, r.target, r.rounds, r.target - r.rounds * r.source_size as budget,
    sum(size) over (partition by h.source order by h range between unbounded preceding and current row) as upto,
    sum(size) over (partition by h.source, h) as own
  from hashed h join rounds r on h.source is not distinct from r.source
)
select doc_id, size, source_size, target,
  (size * (rounds + case when budget > 0 and (upto <= budget
    or upto - own <= budget and upto - budget < budget - (upto - own)) then 1 else 0 end))::bigint as taken
from sums
"""


@query("op6_mixing_sources", OP6_SQL)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    sizes = table(spark, folder, "documents").select("doc_id", "source", mixing.word_count(F.col("text")).alias("words"))
    units = sharding.copies_in_blocks(sizes, ["doc_id", "source", "words"], block=64)
    rows = stored(units.withColumn("hash", sharding.digest60(F.col("doc_id"), F.col("words"), F.col("block"))), "units")
    plan = mixing.mix_plan(rows.select("source", "hash", (F.col("words") * F.col("copies")).alias("size")), (5, 2, 1), 1.5, 2)
    each = mixing.planned(rows, plan).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return each.select("doc_id", F.col("words").alias("size"), "source_size", "target", (F.col("words") * F.col("times")).alias("taken"))


URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]

OP9_SQL = r"""
with rules(verdict, rule, rule_host, rule_path) as (
  values ('block', 'net/', 'net', '/'), ('allow', 'example.net/en/', 'example.net', '/en/'),
    ('block', 'example.com/de/', 'example.com', '/de/'), ('allow', 'org/fr/', 'org', '/fr/')
), rests as (
  select page_id, url, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages
), hosts as (
  select page_id, url, rest, regexp_extract(rest, '^[^/?#]*') as raw_host from rests
), parts as (
  select page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*') as path from hosts
)
select page_id, host, path,
  (select arg_max(r.rule, length(r.rule)) from rules r
   where (p.host = r.rule_host or ends_with(p.host, '.' || r.rule_host)) and starts_with(p.path, r.rule_path)) as rule,
  coalesce((select arg_max(r.verdict, length(r.rule)) from rules r
   where (p.host = r.rule_host or ends_with(p.host, '.' || r.rule_host)) and starts_with(p.path, r.rule_path)), 'allow') as verdict
from parts p
"""


@query("op9_url_filters", OP9_SQL)
def op9(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    return urls.apply_rules(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


OP7_SQL = r"""
with doc_words as (
  select doc_id, text, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
  from documents
), items as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
  from benchmark
), item_windows as (
  select distinct item_id, least(len(words), 10) as n, array_to_string(words[i : i + 9], ' ') as win
  from items, unnest(range(1, greatest(len(words) - 9, 1) + 1)) t(i) where len(words) > 0
), sizes as (
  select distinct n from item_windows
), doc_windows as (
  select doc_id, i, n, array_to_string(words[i : i + n - 1], ' ') as win
  from doc_words, sizes, unnest(range(1, len(words) - n + 2)) t(i) where len(words) >= n
), found as (
  select d.doc_id, d.i, d.n, w.item_id from doc_windows d join item_windows w on d.n = w.n and d.win = w.win
), hits as (
  select doc_id, count(distinct p) as n_hit from found, unnest(range(i, i + n)) t(p) group by doc_id
), listed as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as ids
  from (select distinct doc_id, item_id::varchar as item from found) group by doc_id
)
select d.doc_id, len(d.words)::bigint as n_words, coalesce(h.n_hit, 0)::bigint as n_hit,
  coalesce(l.n_items, 0)::bigint as n_items, sha256(coalesce(l.ids, '')) as items_sha256, h.n_hit is not null as contaminated
from doc_words d left join hits h using (doc_id) left join listed l using (doc_id)
"""


@query("op7_benchmark_decontamination", OP7_SQL)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontamination.contamination(docs, table(spark, folder, "benchmark"), length=10)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


@query("op10_html_extraction")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return extraction.extract_main_text(table(spark, folder, "pages"), ["page_id", "url"])


OP2_SQL = r"""
with usable as (
  select vec_id, list_transform(embedding, lambda x: floor(x::double * 256)::bigint) as v from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.vec_id as query_id, d.vec_id,
    coalesce(list_sum(list_transform(range(1, least(len(q.v), len(d.v)) + 1), lambda i: q.v[i] * d.v[i])), 0)::bigint as score
  from usable q join usable d on q.vec_id <> d.vec_id where q.vec_id % 50 = 0
), ranked as (
  select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 5
"""


@query("op2_exact_top_k", OP2_SQL)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings").select("vec_id", knn.quantized(F.col("embedding")).alias("v"))
    return knn.exact_top_k(rows.where(F.col("vec_id") % 50 == 0), rows, "vec_id", "v", k=5)


def held_out() -> Column:
    """Rows that the language model must not learn from."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


def language_model(docs: DataFrame) -> language.Model:
    return language.fit(docs.where(~F.coalesce(held_out(), F.lit(False))))


@query("op4_language_id")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    rows = docs.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "text")
    found = language.identify(rows, language_model(docs), ["doc_id", "held_out"])
    return found.select("doc_id", "held_out", "lang_pred", "score")


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with one of five faults in a quarter of the rows, by the checksum of id and turn."""
    spaced = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    fault = F.crc32(F.concat(spaced[0], F.lit(":"), spaced[1]).cast("binary")) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    hit = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), fault.alias("fault")).where("fault <> 0")
    shown = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return hit.select(
        "conv_id",
        "turn",
        F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        shown.alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("fault") == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


@query("op11_conversation_structure_repair")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations")
    repaired = conversations.repair(damaged(rows))
    ids = rows.select("conv_id").distinct()
    summary = repaired.summary.withColumnRenamed("conv_id", "of")
    texts = conversations.digests(repaired.blocks).withColumnRenamed("conv_id", "by")
    found = ids.join(summary, F.col("conv_id").eqNullSafe(F.col("of")), "left").join(texts, F.col("conv_id").eqNullSafe(F.col("by")), "left")
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return found.select(
        "conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256")
    )


@query("op12_token_id_binary_output")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    path = new_folder(spark, "token-ids")
    tokens.write_token_ids(docs, path, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return tokens.token_documents(tokens.read_token_ids(spark, path, tokens.token_schema(docs)))


OP13_SQL = r"""
with docs as (
  select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') as lines,
    sha256('7:' || coalesce(doc_id::varchar, '')) as hex from documents
), cuts as (
  select *, len(lines)::bigint as n, ('0x' || substr(hex, 1, 8))::bigint % (len(lines) + 1) as a,
    ('0x' || substr(hex, 9, 8))::bigint % (len(lines) + 1) as b, ('0x' || substr(hex, 25, 8))::bigint % 100 as h4 from docs
), parts as (
  select *, array_to_string(lines[1 : least(a, b)], '') as p, array_to_string(lines[least(a, b) + 1 : greatest(a, b)], '') as m,
    array_to_string(lines[greatest(a, b) + 1 : n], '') as s,
    case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') then 'plain'
      when h4 < 50 then 'spm' else 'psm' end as form from cuts
)
select doc_id, n, form, case when form <> 'plain' then length(p)::bigint end as prefix_chars,
  case when form <> 'plain' then length(m)::bigint end as middle_chars,
  sha256(case form when 'plain' then text when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
    else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256, sha256(text) as restored_sha256
from parts
"""


@query("op13_fill_in_middle", OP13_SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    framed = stored(infill.in_frames(table(spark, folder, "documents").select("doc_id", "text")), "frames")
    return infill.digests(infill.fill_in_middle(framed, seed=7, rate=100, spm=50))
