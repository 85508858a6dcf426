"""The operators of this subpackage as queries over the given tables, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from souklake.llm import (
    chat, decontaminate, jaccard, language, lines, mixing, quality, resampling, secrets, shards, toxicity, trie,
    urls,
)
from souklake.session import tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def wrap(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: fn(tune(spark), sf_dir)
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register("op3_mixing")
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashes differ between engines, so SQL cannot tell which documents lie below a threshold."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    taken = F.col("size") * F.col("copies")
    return mixed.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"))


LINES_SQL = r"""
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
  from documents),
keyed as (
  select *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from lines),
shared as (
  select key, max(doc_id) as keeper from keyed where length(key) >= 20
  group by key having count(distinct doc_id) >= 3)
select doc_id, count(*) as n_lines, count(*) filter (where s.key is not null and doc_id <> keeper) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where s.key is null or doc_id = keeper), ''))
    as kept_sha256
from keyed left join shared s using (key) group by doc_id"""


@register("op7_line_dedup", LINES_SQL)
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.drop_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@register("op9_sharding")
def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Differencing is iterative, so SQL has no equal."""
    return shards.assign_shards(table(spark, sf_dir, "documents"), 8).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


DECONTAMINATION_SQL = r"""
with doc_words as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
item_words as (
  select item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
windows as (
  select distinct item_id, least(13, len(w)) as n, w[i:i + least(13, len(w)) - 1] as words
  from (select *, unnest(range(1, len(w) - least(13, len(w)) + 2)) as i from item_words where len(w) > 0)),
lengths as (select distinct n from windows),
doc_windows as (
  select doc_id, n, i, w[i:i + n - 1] as words
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from doc_words, lengths where len(w) >= n)),
hits as (select doc_id, i, n, item_id from doc_windows join windows using (n, words)),
hit_words as (
  select doc_id, count(distinct p) as n_hit
  from (select doc_id, unnest(range(i, i + n)) as p from hits) group by doc_id),
hit_items as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct doc_id, cast(item_id as varchar) as item from hits) group by doc_id)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(items, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from doc_words left join hit_words using (doc_id) left join hit_items using (doc_id)"""


@register("op1_quality")
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cutoffs come from exact binomial tails, which SQL cannot express at a bearable length."""
    judged = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("doc_id", *counts, "base_failed", "kept", "rejected_by")


@register("op5_decontamination", DECONTAMINATION_SQL)
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"

CHAT_SQL = f"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-1, 0, 'user', '{CONTROL_TEXT}'), (-1, 1, 'assistant', '{CONTROL_TEXT}')),
escaped as (
  select *, regexp_replace(text, '<(\\\\*)\\|', '<\\\\\\1|', 'g') as written from rows)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, text) filter (where role = 'assistant'), '')) as loss_sha256,
  cast(sum(length('<|im_start|>') + length(role) + 1 + length(written) + length('<|im_end|>') + 1) as bigint)
    as formatted_chars
from escaped group by conv_id"""


@register("op4_chat_format", CHAT_SQL)
def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    who = F.when(F.col("id") == 0, "user").otherwise("assistant")
    added = (F.lit(-1), F.col("id"), who, F.lit(CONTROL_TEXT))
    extra = spark.range(2).select(*(value.cast(f.dataType).alias(f.name) for value, f in zip(added, given.schema)))
    formatted = chat.format_log(chat.replayed_log(given.union(extra)))
    turns = chat.read_back(formatted)
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    trained = F.array_compact(F.transform("turns", lambda t: t["trained"]))
    return turns.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.char_length(F.array_join(trained, "")).cast("long").alias("loss_chars"),
        F.sha2(F.array_join(trained, ""), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


URL_RULES = [
    ("org", "/", urls.ALLOW),
    ("example.org", "/es/", urls.BLOCK),
    ("example.org", "/en/1", urls.BLOCK),
    ("com", "/fr/", urls.ALLOW),
    ("com", "/de/", urls.BLOCK),
]

URL_SQL = r"""
with rules(rule_host, rule_path, verdict) as (
  values ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
    ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
split_urls as (
  select page_id, url,
    translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') as path
  from pages)
select p.page_id, p.host, p.path, arg_max(r.rule_host || r.rule_path, length(r.rule_host || r.rule_path)) as rule,
  coalesce(arg_max(r.verdict, length(r.rule_host || r.rule_path)), 'allow') as verdict
from split_urls p left join rules r
  on (p.host = r.rule_host or ends_with(p.host, '.' || r.rule_host)) and starts_with(p.path, r.rule_path)
group by p.page_id, p.url, p.host, p.path"""


@register("op6_url_filter", URL_SQL)
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


@register("op2_language_id")
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    sample = language.draw_sample(docs.where(~held_out & F.col("doc_id").isNotNull()))
    return language.predict(docs, sample).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@register("op10_secrets")
def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))

    def listed(spans):
        parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
        return F.array_join(parts, ",")

    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


@register("op8_jaccard_join")
def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components need iteration over links that SQL can only find by comparing pairs."""
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


# crc32 by its table, one byte of a hexadecimal text per step: crc_table and, from rows of ``keys`` (x), ``crc`` (x, v).
CRC_SQL = r"""
crc_steps(byte, k, v) as (
  select range, 0, range from range(256)
  union all
  select byte, k + 1, case when v & 1 = 1 then xor(3988292384, v >> 1) else v >> 1 end from crc_steps where k < 8),
crc_table as (select byte, v from crc_steps where k = 8),
crc_walk(x, k, c) as (
  select distinct x, 0, 4294967295 from keys
  union all
  select x, crc_walk.k + 1, xor(c >> 8, v)
  from crc_walk join crc_table on byte = xor(c & 255, cast('0x' || substr(x, 2 * crc_walk.k + 1, 2) as bigint))
  where 2 * crc_walk.k < length(x)),
crc as (select x, xor(c, 4294967295) as v from crc_walk where 2 * k = length(x))"""

RESAMPLING_SQL = rf"""
with recursive texts as (
  select 0 as side, doc_id as id, text from documents union all select 1, item_id, text from benchmark),
worded as (
  select side, id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from texts),
runs as (
  select side, id, unnest(w) as f from worded
  union all
  select side, id, unnest([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) from worded),
counted as (select side, id, hex(encode(f)) as x, count(*) as n from runs group by all),
keys as (select distinct x from counted),{CRC_SQL},
found as (select side, id, v % 10000 as bucket, n from counted join crc using (x)),
buckets as (
  select bucket, coalesce(sum(n) filter (where side = 0), 0) as s, coalesce(sum(n) filter (where side = 1), 0) as t
  from found group by bucket),
totals as (select sum(s) as all_s, sum(t) as all_t from buckets),
gains as (
  select bucket, cast(floor(1000 * ln(((t + 1)::double * (all_s + 10000)::double)
    / ((s + 1)::double * (all_t + 10000)::double))) as bigint) as gain from buckets, totals),
weights as (
  select id, sum(n) as n_features, cast(floor(sum(n * gain) / sum(n)) as bigint) as weight
  from found join gains using (bucket) where side = 0 group by id),
scored as (
  select id as doc_id, len(w) as n_words, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
    coalesce(weight, 0) + cast(floor(-1000 * ln(-ln(
      (cast('0x' || substr(sha256('7:' || id), 1, 8) as bigint) + 0.5::double) / 4294967296::double))) as bigint) as score
  from worded left join weights using (id) where side = 0),
ranked as (
  select doc_id, row_number() over (order by score desc, doc_id) as r, count(*) over () as n
  from scored where n_words >= 20)
select doc_id, cast(n_features as bigint) as n_features, weight, score, case when r <= 25 * n // 100 then r end as rank
from scored left join ranked using (doc_id)"""


@register("op11_resampling", RESAMPLING_SQL)
def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = resampling.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return ranked.select("doc_id", "n_features", "weight", "score", "rank")


@register("op12_toxicity")
def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A trained model has no equal in SQL."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    model = toxicity.train(*toxicity.draw_sample(docs, labels.where(~held_out)))
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


TRIE_SQL = rf"""
with recursive given as (
  select conv_id, turn, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as id,
    strlen(coalesce(text, '')) as size
  from conversations where conv_id is not null),
placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, id) as pos from given),
convs as (select distinct conv_id, hex(encode(conv_id::varchar)) as x from placed),
keys as (select x from convs),{CRC_SQL},
heads as (select conv_id, v % 9 as h from convs join crc using (x)),
rebuilt as (
  select c.conv_id, p.pos, p.id, p.size from heads c join placed p on p.conv_id = c.conv_id - c.conv_id % 5
  where p.pos <= h
  union all
  select c.conv_id, p.pos + 1000000, p.id, p.size from heads c join placed p using (conv_id) where p.pos > h),
steps as (
  select conv_id, row_number() over w as depth, string_agg(id, '') over w as prefix, size
  from rebuilt window w as (partition by conv_id order by pos)
  union all
  select conv_id, 0, '', 0 from heads),
lengths as (select conv_id, max(depth) as len from steps group by conv_id),
nodes as (
  select depth, prefix, min(conv_id) as conv_id, count(*) as n_convs, min(size) as size,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where len = depth), '')) as ends_sha256
  from steps join lengths using (conv_id) group by depth, prefix),
counted as (
  select n.*, p.conv_id as parent_conv_id,
    (select count(*) from nodes c where c.depth = n.depth + 1 and substr(c.prefix, 1, 64 * n.depth::int) = n.prefix)
      as n_children
  from nodes n left join nodes p on p.depth = n.depth - 1 and p.prefix = substr(n.prefix, 1, 64 * (n.depth::int - 1))),
below as (
  select distinct a.depth, a.prefix, b.depth as d, b.prefix as p
  from steps a join steps b on a.conv_id = b.conv_id and b.depth >= a.depth),
sums as (
  select b.depth, b.prefix, count(*) filter (where c.n_children = 0) as n_leaves,
    sum(case when c.depth > 0 then (c.n_convs - 1) * c.size else 0 end) as saved_tokens
  from below b join counted c on c.depth = b.d and c.prefix = b.p group by b.depth, b.prefix)
select conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, cast(saved_tokens as bigint) as saved_tokens,
  ends_sha256
from counted join sums using (depth, prefix)"""


@register("op13_prefix_trie", TRIE_SQL)
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = F.col("conv_id").cast("long")
    given = table(spark, sf_dir, "conversations")
    paths = trie.conversation_paths(given, family=conv - conv % 5)
    head = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).cast("int")
    return trie.prefix_nodes(trie.share_heads(paths, F.col("family"), head, longest=8))
