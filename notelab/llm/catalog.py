"""The registered queries of this subpackage and the SQL for those that DuckDB
can express over the same tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from notelab.llm import (
    decontaminate, jaccard_join, line_dedup, merkle, packing, quality_rules, ranked_search, secret_scan, sharding, simhash,
    substring_dedup, toxicity, url_filter,
)
from notelab.llm.common import shared_folder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return register


@query("op1_quality_rules")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op2_jaccard_join")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.components(table(spark, sf_dir, "documents"))


@query("op3_substring_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = substring_dedup.dedup_passages(docs, spans="spans", local=True)
    total = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, x: acc + x["words"])
    return out.select(
        "doc_id", total.alias("n_dropped_words"), F.size("spans").cast("long").alias("n_spans"),
        F.array_join(F.transform("spans", lambda x: F.concat_ws(":", x["start"].cast("string"), x["end"].cast("string"))), ",").alias("spans"),
        "text")


URL_RULES = [url_filter.rule(*x) for x in (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))]


@query("op4_url_filter")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


@query("op5_benchmark_decontamination")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op6_sharding")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents"), shared_folder(spark, "slot-map"), 16)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")


def tokenizer_files() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


@query("op7_best_fit_packing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.token_pieces(table(spark, sf_dir, "documents"), *tokenizer_files()))


@query("op8_toxicity")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP9_SQL = r"""
with l as (
  select doc_id, row_number() over () r, unnest(string_split(coalesce(text, ''), chr(10))) line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) i
  from documents),
k as (
  select *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from l),
rep as (
  select key, max(doc_id) keeper from k where length(key) >= 40 group by key having count(distinct doc_id) >= 5)
select k.doc_id, count(*) n_lines, count(rep.key) filter (k.doc_id is distinct from keeper) n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by i) filter (rep.key is null or k.doc_id is not distinct from keeper), '')) kept_sha256
from k left join rep on rep.key = k.key group by k.doc_id
"""


@query("op9_line_dedup", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_dedup.dedup_lines(docs, counts=("n_lines", "n_dropped"))
    return out.select("doc_id", "n_lines", "n_dropped",
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query("op10_secret_scan")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, spans = secret_scan.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    s = F.col(spans)

    def joined(x: Column) -> Column:
        return F.concat_ws(",", F.transform(x, lambda y: F.concat_ws(":", y["kind"], y["start"].cast("string"), y["end"].cast("string"))))

    def count(kind: str) -> Column:
        return F.size(F.filter(s, lambda y: y["kind"] == kind)).cast("long")

    base = [r.kind for r in secret_scan.BASE_RULES]
    return found.select(
        "doc_id", *(count(k).alias(f"n_{k}") for k in base),
        F.sha2(joined(F.filter(s, lambda y: y["kind"].isin(base))), 256).alias("base_sha256"), joined(s).alias("spans"))


OP11_SQL = r"""
with low as (
  select doc_id, row_number() over () r, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from documents),
d as (select doc_id, r, len(w) n, unnest(w) t from low where len(w) > 0),
total as (select count(distinct r) as big_n, count(*) as big_l from d),
tf as (select doc_id, r, n, t, count(*) tf from d group by all),
q as (
  select i, item_id, t, count(*) repeats from (
    select row_number() over () i, item_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) t
    from benchmark) group by all),
w as (
  select t, cast(floor(1000 * ln((2 * big_n + 2)::double / (2 * count(*) + 1)::double)) as bigint) w
  from tf, total group by t, big_n),
s as (
  select i, item_id, doc_id, r,
         sum(repeats * w.w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * big_n) // big_l)))) score
  from q join tf on tf.t = q.t join w on w.t = q.t, total group by all),
o as (
  select *, row_number() over (partition by i order by score desc, doc_id nulls last) as pos from s where score > 0)
select item_id, cast(pos as int) as rank, doc_id, cast(score as bigint) score from o where pos <= 10
"""


@query("op11_ranked_search", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def merkle_sql(levels: int = 8) -> str:
    """Manifest in plain SQL, for groups of at most 8 ** levels rows and as many
    groups."""
    def field(c: str) -> str:
        return f"coalesce(strlen(cast({c} as varchar))::varchar || ':' || cast({c} as varchar), '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(map(field, ("doc_id", "source", "lang", "n_chars", text))) + ")"

    def tree(name: str, base: str) -> str:
        """Nodes of every level (name0, ...) and their siblings (name_s0, ...)."""
        out = f"{name}0 as materialized ({base})"
        for k in range(levels):
            out += f""",
{name}_s{k} as materialized (
  select g, i, n > 1 as live, coalesce(string_agg(h, '') over (w rows between unbounded preceding and 1 preceding), '') l,
         coalesce(string_agg(h, '') over (w rows between 1 following and unbounded following), '') r
  from {name}{k} window w as (partition by g, i // 8 order by i)),
{name}{k + 1} as materialized (
  select g, i // 8 i, (any_value(n) + 7) // 8 n, case when any_value(n) > 1 then sha256(string_agg(h, '' order by i)) else any_value(h) end h
  from {name}{k} group by g, i // 8)"""
        return out

    def walk(name: str, base: str, at: str) -> str:
        """The fold and the proof, a level a step."""
        out = f"{name}f0 as materialized ({base})"
        for k in range(levels):
            out += f""",
{name}f{k + 1} as materialized (
  select x.* replace (case when s.live then sha256(s.l || x.f || s.r) else x.f end as f, x.proof || coalesce(s.l || s.r, '') as proof)
  from {name}f{k} x left join {name}_s{k} s on s.live and s.g = x.{at}g and s.i = x.{at}i // {8 ** k})"""
        return out

    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
with crc_table as materialized (
  select list(v order by b) t from (
    select b, list_reduce([b::ubigint] || [0::ubigint, 0, 0, 0, 0, 0, 0, 0], lambda c, z:
      case when c & 1 = 1 then xor(3988292384::ubigint, c >> 1) else c >> 1 end) v from range(256) x(b))),
rows0 as (
  select doc_id, case when lang is null then '' else '=' || lang end g, {leaf('text')} leaf, {leaf(low)} low,
         [ord(c)::ubigint for c in string_split(cast(doc_id as varchar), '')] chars from documents),
rows1 as materialized (
  select doc_id, g, leaf, case when xor(4294967295::ubigint, list_reduce([4294967295::ubigint] || chars, lambda c, z:
      xor(t[cast(xor(c, z) & 255 as int) + 1], c >> 8))) % 3 = 0 then low else leaf end claimed from rows0, crc_table),
x as materialized (
  select *, row_number() over (partition by g order by doc_id nulls first, leaf) - 1 i, count(*) over (partition by g) n from rows1),
{tree('a', 'select g, i, n, leaf h from x')},
y as materialized (select g, h, row_number() over (order by g) - 1 i, count(*) over () n from a{levels}),
{tree('b', 'select 0 g, i, n, h from y')},
{walk('a', "select doc_id, g, i, leaf, claimed f, '' proof from x", '')},
{walk('b', f'select af.*, y.h subroot, 0 yg, y.i yi from af{levels} af join y on y.g = af.g', 'y')}
select doc_id, leaf, subroot, b.h as root, sha256(proof) proof_sha256, f folded_root, f = b.h verified from bf{levels}, b{levels} b
"""


@query("op12_merkle_manifest", merkle_sql())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = merkle.manifest(table(spark, sf_dir, "documents"), check=merkle.lowered_leaf())
    return out.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"),
                      F.col("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))


@query("op13_simhash_near_dedup")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.components(table(spark, sf_dir, "documents"))


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
