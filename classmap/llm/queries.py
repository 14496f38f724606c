"""One query per operator over the given tables, with its SQL where there is one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from classmap.llm import (
    conversations,
    decontaminate,
    exact_dedup,
    hard_negatives,
    line_dedup,
    lm_scoring,
    packing,
    quality,
    sharding,
    simhash,
    token_files,
    url_filter,
    warc,
)

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
CRAWL_DATE = "2024-01-01T00:00:00Z"
# Rules on host and path, as the judged table needs them.
RULES = (
    url_filter.Rule("allow", "org", "/"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_cross_entropy_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against those labelled as good."""
    docs = _read(spark, sf_dir, "documents")
    # Labels grow with the documents, so the plan does not lean on broadcasting them.
    good = _read(spark, sf_dir, "labels").where("quality = 1").select("doc_id").hint("merge")
    return lm_scoring.cross_entropy_difference(docs, docs.select("doc_id", "text").join(good, "doc_id", "left_semi"))


def op2_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.derivatives(warc.responses(_read(spark, sf_dir, "pages"), date=CRAWL_DATE))
    return records.withColumnRenamed("source_id", "page_id")


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_read(spark, sf_dir, "documents"))


def op4_minimax_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_read(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.drop_repeated_lines(_read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained_items(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(_read(spark, sf_dir, "pages"), RULES)


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, _read(spark, sf_dir, "labels")))


def op9_cost_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"), TOKENIZER)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_read(spark, sf_dir, "documents"))


def op11_simple8b_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_documents(_read(spark, sf_dir, "documents"), TOKENIZER)


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with planted faults; those that are dropped stay, marked as not present."""
    kind = F.crc32(F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    worse = rows.select(
        "conv_id", "turn", (kind != 0).alias("present"), F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1)).alias("copies"),
    )
    return worse.select("*", F.explode("copies").alias("copy")).drop("copies", "copy")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_digests(damaged(_read(spark, sf_dir, "conversations")), present=F.col("present"))


def op13_hard_negative_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _read(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(vectors.withColumn("label", moved), anchor=F.col("vec_id") % 50 == 0)


LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

LINES_SQL = f"""
with d as (select doc_id, coalesce(text, '') as body from documents),
l as (
  select doc_id, unnest(string_split(body, chr(10))) as line,
         generate_subscripts(string_split(body, chr(10)), 1) as place
  from d),
k as (
  select doc_id, place, line,
         {LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} as key
  from l),
r as (
  select key, max(doc_id) as last_id from k where length(key) >= 20
  group by key having count(distinct doc_id) >= 3)
select k.doc_id, count(*) as n_lines,
       count(*) filter (where r.key is not null and k.doc_id <> r.last_id) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by place)
                       filter (where r.key is null or k.doc_id = r.last_id), '')) as kept_sha256
from k left join r on k.key = r.key
group by k.doc_id
"""

COPIES_SQL = f"""
with t as (select doc_id, {LOWER.format("coalesce(text, '')")} as body from documents),
g as (select body, max(doc_id) as keep_id, count(*) as group_size from t group by body)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(t.body) as text_sha256
from t join g on t.body = g.body
"""


def _repair_sql() -> str:
    """The same damage, and the cheapest edits row by row from the end, by whole audits."""
    follow, names = {1: 3, 2: 3, 3: 4, 4: 3}, {1: "user", 2: "user", 3: "assistant", 4: "user"}
    keeps = {1: {"s": 2, "u": 3}, 2: {"u": 3}, 3: {"a": 4}, 4: {"u": 3}}
    entry = "{{'c': {c}, 'a': {a}, 't': {t}}}".format

    def best(q: int) -> str:
        then = follow[q]
        ways = [entry(c=f"s[{q}].c + 4", a=f"'D' || s[{q}].a", t=f"s[{q}].t")]
        for initial, to in keeps[q].items():
            kept = entry(c=f"s[{to}].c + cut", a=f"'K' || s[{to}].a", t=f"chr(10) || role || ':' || text || s[{to}].t")
            ways.append(f"case when stays and initial = '{initial}' then {kept} end")
        moved = entry(c=f"s[{then}].c + cut + 3", a=f"'R' || s[{then}].a", t=f"chr(10) || '{names[q]}:' || text || s[{then}].t")
        return f"list_min([{', '.join([*ways, f'case when stays then {moved} end'])}])"

    def inserted(q: int) -> str:
        put = entry(c=f"s[{follow[q]}].c + 3", a=f"'I' || s[{follow[q]}].a", t=f"chr(10) || '{names[q]}:' || s[{follow[q]}].t")
        return f"list_min([s[{q}], {put}])"

    each = lambda f: "[" + ", ".join(map(f, (1, 2, 3, 4))) + "]"
    ended = each({1: entry(c=0, a="''", t="''"), 2: entry(c=6, a="'II'", t="chr(10) || 'user:' || chr(10) || 'assistant:'"),
                  3: entry(c=3, a="'I'", t="chr(10) || 'assistant:'"), 4: entry(c=0, a="''", t="''")}.get)
    step = f"select conv_id, place, {each(best)} as s from (select r.*, rec.s from rec join turns r on r.conv_id is not distinct from rec.conv_id and r.place = rec.place - 1)"
    for _ in range(3):
        step = f"select conv_id, place, {each(inserted)} as s from ({step})"
    space = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
with recursive
crc as (
  select list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by i) as t
  from range(256) as r(i)),
named as (
  select *, coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as name from conversations),
coded as (
  select named.*, xor(list_reduce(list_concat([4294967295::bigint], list_transform(string_split(name, ''), lambda x: ascii(x)::bigint)),
                      lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1])), 4294967295) % 20 as kind
  from named, crc),
damaged as (
  select conv_id, turn, case when kind = 4 then 'user' else coalesce(role, ' ') end as role,
         case kind when 1 then '' when 2 then regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') else coalesce(text, ' ') end as text,
         unnest(range(case when kind = 3 then 2 else 1 end)) as copy
  from coded where kind <> 0),
placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as place, left(role, 1) as initial,
         right(rtrim(text, {space}), 1) as ends
  from damaged),
faults as (
  select *, ends = '' as blank, ends <> '' and row_number() over (partition by conv_id, role, text order by place) > 1 as again,
         lag(initial) over (partition by conv_id order by place) as before
  from placed),
judged as (
  select *, not blank and not again as stays, not blank and not again and ends not in ('.', '!', '?') as short from faults),
counts as (
  select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
         count(*) filter (blank) as blank, count(*) filter (again) as duplicate, count(*) filter (short) as truncated,
         count(*) filter (before is not null and before || initial not in ('su', 'ua', 'au')) as illegal
  from judged group by conv_id),
rec as (
  select c.conv_id, coalesce(n, 0) + 1 as place, {ended} as s
  from (select distinct conv_id from conversations) as c left join counts on counts.conv_id is not distinct from c.conv_id
  union all
  {step.replace("join turns r", "join (select *, case when short then 3 else 0 end as cut from judged) r")})
select rec.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
       coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, s[1].c::bigint as cost, s[1].a as audit,
       sha256(substr(s[1].t, 2)) as repaired_sha256
from rec left join counts on counts.conv_id is not distinct from rec.conv_id
where rec.place = 1
"""


NEGATIVES_SQL = """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)) as codes
  from embeddings
  where label is not null and vec_id is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select a.vec_id as anchor_id, v.vec_id, a.label = v.label as alike,
         list_inner_product(a.codes, v.codes)::bigint as score
  from v as a join v on a.vec_id <> v.vec_id where a.vec_id % 50 = 0),
p as (
  select anchor_id, vec_id as positive_id, score as positive_score from s where alike
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select anchor_id, positive_id, s.vec_id as negative_id, positive_score, s.score as negative_score,
       row_number() over (partition by anchor_id, positive_id order by s.score desc, s.vec_id)::int as rank
from p join s using (anchor_id)
where not alike and 50 * positive_score <= 100 * s.score and 100 * s.score <= 95 * positive_score
qualify rank <= 3
"""


def _url_sql() -> str:
    """The same rules and vocabulary, each term as a pattern of its own."""
    fits = {
        r.name: f"((host = '{r.host}' or ends_with(host, '.{r.host}')) and starts_with(path, '{r.path}'))" for r in RULES
    }
    ordered = sorted(RULES, key=lambda r: -len(r.name))
    rule = " ".join(f"when {fits[r.name]} then '{r.name}'" for r in ordered)
    verdict = " ".join(f"when {fits[r.name]} then '{r.verdict}'" for r in ordered)
    words = url_filter.VOCABULARY

    def hit(term: str) -> str:
        return f"regexp_matches(address, '(^|[^a-z0-9]){term}([^a-z0-9]|$)')::int"

    def count(term: str) -> str:  # overlapping neighbours: a boundary may serve two hits
        return f"len(regexp_extract_all(regexp_replace(address, '[^a-z0-9]', '..', 'g'), '(^|[^a-z0-9]){term}([^a-z0-9]|$)'))"

    strict, soft = "+".join(map(count, words.strict)), "+".join(map(hit, words.soft))
    return f"""
with u as (
  select page_id, coalesce(url, '') as url, {LOWER.format("coalesce(url, '')")} as address from pages),
p as (
  select *, {LOWER.format("regexp_extract(url, '^.*?://([^/?#]*)', 1, 's')")} as host,
         regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's') as path,
         ({strict})::int as strict_hits, ({soft})::int as soft_hits
  from u)
select page_id, host, path, case {rule} end as rule,
       case {verdict} when strict_hits > 0 or soft_hits >= {words.soft_needed} then 'block' else 'allow' end as verdict,
       strict_hits, soft_hits
from p
"""


QUERIES = {
    f.__name__: f
    for f in (
        op1_cross_entropy_difference,
        op2_warc_derivatives,
        op3_simhash_near_dedup,
        op4_minimax_sharding,
        op5_line_dedup,
        op6_benchmark_decontamination,
        op7_url_filter,
        op8_quality_classifier,
        op9_cost_balanced_packing,
        op10_exact_dedup,
        op11_simple8b_token_files,
        op12_conversation_repair,
        op13_hard_negative_mining,
    )
}
QUERIES["pipeline"] = corpus_pipeline.run
ORACLES = {
    "op5_line_dedup": LINES_SQL,
    "op7_url_filter": _url_sql(),
    "op10_exact_dedup": COPIES_SQL,
    "op12_conversation_repair": _repair_sql(),
    "op13_hard_negative_mining": NEGATIVES_SQL,
}
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
