"""The registered queries of the operators, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formweave.llm.chat import conversation_digests, format_conversations
from formweave.llm.curve_packing import pack_documents
from formweave.llm.decontaminate import contaminated
from formweave.llm.fingerprint import edited_fingerprints
from formweave.llm.html_text import extract_pages
from formweave.llm.language_model import lm_scores
from formweave.llm.line_dedup import drop_recurring_lines
from formweave.llm.merkle import manifest
from formweave.llm.mixing import mix_sources
from formweave.llm.prefix_trie import prefix_trie
from formweave.llm.quality import quality_scores
from formweave.llm.set_join import near_duplicates
from formweave.llm.toxicity import toxicity_scores


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(modulus: int, remainder: int):
    """The fixed fold: crc32 of the doc_id as text."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus)) == remainder


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every text, learnt outside the fold 0 of 5."""
    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), held_out(5, 0))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every text, learnt outside the fold 1 of 3."""
    return toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), held_out(3, 1))


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations formatted and read back, plus one (-1) whose texts
    look like a template."""
    sample = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", sample), (-1, 1, "assistant", sample)],
                                  "conv_id bigint, turn bigint, role string, text string")
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(extra)
    return conversation_digests(format_conversations(turns)).drop("n_tokens")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its recurring lines."""
    return drop_recurring_lines(_table(spark, sf_dir, "documents")).select(
        "doc_id", "dropped_lines", "text", F.length("text").cast("bigint").alias("n_chars"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark passage, with the passage."""
    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("mark")


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract_pages(_table(spark, sf_dir, "pages"))


def op7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the fixed source weights."""
    return mix_sources(_table(spark, sf_dir, "documents"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text."""
    return edited_fingerprints(_table(spark, sf_dir, "documents"))


def op9_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every text, learnt from the rows outside the fold 2 of 7."""
    return lm_scores(_table(spark, sf_dir, "documents"), held_out(7, 2))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes on four-word shingles at 0.8."""
    return near_duplicates(_table(spark, sf_dir, "documents"), k=4, percent=80)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations."""
    return prefix_trie(_table(spark, sf_dir, "conversations"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents, checked against rows of which those in
    the fold 0 of 7 have one more in n_chars."""
    return manifest(_table(spark, sf_dir, "documents"), tampered=held_out(7, 0))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return pack_documents(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_toxicity": op2_toxicity,
    "op3_chat": op3_chat,
    "op4_line_dedup": op4_line_dedup,
    "op5_decontamination": op5_decontamination,
    "op6_html_text": op6_html_text,
    "op7_mix": op7_mix,
    "op8_fingerprints": op8_fingerprints,
    "op9_lm_scores": op9_lm_scores,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_merkle": op12_merkle,
    "op13_packing": op13_packing,
}

# Independent DuckDB SQL.  The escaped control strings of the template are
# fixed values; what is counted is their length after one more backslash.
_ESCAPED = r"""regexp_replace(regexp_replace({0},
    '(<)(\\*(?:\|(?:turn|text|end|image|audio|document|im_start|im_end|endoftext|eot_id|start_header_id|end_header_id)\|>|</?SYS>>|/?s>))',
    '\1\\\2', 'g'), '(\[)(\\*/?INST\])', '\1\\\2', 'g')"""

# CRC-32 of a decimal number's text: the reflected polynomial is a fixed value.
_CRC32 = """xor(list_reduce([4294967295::ubigint] || list_transform(string_split(cast({0} as varchar), ''), lambda c: ascii(c)::ubigint),
    lambda a, b: list_reduce([xor(a, b)] || [0, 0, 0, 0, 0, 0, 0, 0]::ubigint[],
                             lambda x, i: xor(x >> 1, 3988292384::ubigint * (x & 1)))), 4294967295::ubigint)"""
_FIELD = "coalesce(strlen(cast({0} as varchar)) || ':' || cast({0} as varchar), '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "{0}", "text")) + ")"

ORACLES: dict[str, str] = {
    "op3_chat": f"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
loss as (
  select conv_id, string_agg(text, '' order by turn nulls first, role, text) as t from turns
  where role = 'assistant' group by conv_id)
select t.conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
       coalesce(any_value(length(loss.t)), 0) as loss_chars,
       sha256(coalesce(any_value(loss.t), '')) as loss_sha256,
       cast(sum(23 + length({_ESCAPED.format("role")}) + length({_ESCAPED.format("text")})) as bigint) as formatted_chars
from turns t left join loss on loss.conv_id is not distinct from t.conv_id group by t.conv_id""",
    "op7_mix": r"""
with docs as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as size, length(text) as n
  from documents),
keyed as (
  select doc_id, source, size,
         -ln((cast('0x' || substr(md5(concat_ws(':', 'mix', cast(doc_id as varchar))), 1, 13) as bigint) + 0.5)
             / 4503599627370496.0::double)
         / greatest(coalesce(1.0::double / (1.0::double + abs(n::double / greatest(size, 1) - 5.0::double)), 0.0), 1e-9::double) as key
  from docs),
sized as (
  select source, cast(sum(size) as bigint) as source_size,
         [3, 1, 2][((row_number() over (order by source nulls last) - 1) % 3) + 1] as w
  from keyed group by source),
levels as (
  select *, (1.5::double * sum(source_size) over ()
             - 2.0::double * coalesce(sum(source_size) over (order by source_size::double / w, source nulls last
                                                     rows between unbounded preceding and 1 preceding), 0))
            / (sum(w) over () - coalesce(sum(w) over (order by source_size::double / w, source nulls last
                                                      rows between unbounded preceding and 1 preceding), 0)) as level
  from sized),
goal as (
  select source, source_size,
         least(2.0::double * source_size,
               coalesce((select min_by(level, source_size::double / w) from levels where 2.0 * source_size > level * w) * w, 0)) as target
  from sized),
placed as (
  select k.doc_id, k.size, g.source_size, g.target,
         coalesce(sum(k.size) over (partition by k.source order by k.key, k.doc_id, k.size
                                    rows between unbounded preceding and 1 preceding), 0) as before
  from keyed k join goal g on k.source is not distinct from g.source)
select doc_id, cast(size as bigint) as size, source_size, target,
       cast(case when source_size = 0 then 0 else floor(target / source_size) end * size
            + greatest(0, least(size, floor(target)
              - case when source_size = 0 then 0 else floor(target / source_size) end * source_size - before)) as bigint) as taken
from placed""",
    "op11_prefix_trie": f"""
with turns as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as j,
         sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as turn_id,
         length(coalesce(text, '')) as chars
  from conversations where conv_id is not null),
convs as (
  select conv_id, count(*) as n, conv_id - conv_id % 100 as head_id, cast({_CRC32.format("conv_id")} % 6 as bigint) as h
  from turns group by conv_id),
shared as (select c.conv_id, c.h, c.head_id, least(c.h, coalesce(o.n, 0)) as k from convs c left join convs o on o.conv_id = c.head_id),
rebuilt as (
  select s.conv_id, t.j as d, t.turn_id, t.chars from shared s join turns t on t.conv_id = s.head_id and t.j <= s.h
  union all
  select s.conv_id, s.k + t.j - s.h, t.turn_id, t.chars from shared s join turns t on t.conv_id = s.conv_id and t.j > s.h),
prefixes as (
  select conv_id, d, chars, d = max(d) over (partition by conv_id) as is_end,
         sha256(string_agg(turn_id, ',') over (partition by conv_id order by d rows unbounded preceding)) as mark
  from rebuilt
  union all
  select conv_id, 0, 0, conv_id not in (select conv_id from rebuilt), 'root' from convs),
nodes as (
  select mark, min(conv_id) as conv_id, any_value(d) as depth, any_value(chars) as chars, count(*) as n_convs,
         sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (where is_end), '')) as ends_sha256
  from prefixes group by mark),
linked as (
  select n.*, p.mark as parent, o.conv_id as parent_conv_id
  from nodes n left join prefixes p on p.conv_id = n.conv_id and p.d = n.depth - 1 left join nodes o on o.mark = p.mark),
children as (select parent, count(*) as n from linked where parent is not null group by parent),
below as (
  select p.mark, sum(case when c.n is null then 1 else 0 end) as n_leaves, sum((n.n_convs - 1) * n.chars) as saved
  from linked n join prefixes p on p.conv_id = n.conv_id and p.d <= n.depth left join children c on c.parent = n.mark
  group by p.mark)
select n.conv_id, cast(n.depth as bigint) as depth, n.parent_conv_id, n.n_convs, coalesce(c.n, 0) as n_children,
       cast(b.n_leaves as bigint) as n_leaves, cast(b.saved as bigint) as saved_tokens, n.ends_sha256
from linked n left join children c on c.parent = n.mark join below b on b.mark = n.mark""",
    "op12_merkle": f"""
with recursive hashed as (
  select doc_id, lang, {_LEAF.format("n_chars")} as leaf,
         case when doc_id is not null and {_CRC32.format("coalesce(doc_id, 0)")} % 7 = 0
              then {_LEAF.format("(n_chars + 1)")} else {_LEAF.format("n_chars")} end as checked
  from documents),
leaves as (
  select *, row_number() over (partition by lang order by doc_id nulls first, leaf, checked) - 1 as idx,
         count(*) over (partition by lang) as width
  from hashed),
levels as (
  select lang, 0 as lvl, idx, width, leaf as digest from leaves
  union all
  select lang, lvl + 1, idx // 2, (width + 1) // 2, sha256(digest || coalesce(following, ''))
  from (select *, lead(digest) over (partition by lang order by idx) as following from levels where width > 1)
  where idx % 2 = 0),
subroots as (
  select lang, lvl as height, digest, row_number() over (order by lang nulls first) - 1 as idx, count(*) over () as width
  from levels where width = 1),
upper as (
  select 0 as lvl, idx, width, digest from subroots
  union all
  select lvl + 1, idx // 2, (width + 1) // 2, sha256(digest || coalesce(following, ''))
  from (select *, lead(digest) over (order by idx) as following from upper where width > 1) where idx % 2 = 0),
steps as (
  select n.lang, n.lvl, n.idx, case when n.idx % 2 = 1 then 'l' else 'r' end || coalesce(s.digest, '') as step
  from levels n left join levels s on s.lang is not distinct from n.lang and s.lvl = n.lvl and s.idx = xor(n.idx, 1)
  where n.width > 1),
upper_steps as (
  select n.lvl, n.idx, case when n.idx % 2 = 1 then 'l' else 'r' end || coalesce(s.digest, '') as step
  from upper n left join upper s on s.lvl = n.lvl and s.idx = xor(n.idx, 1) where n.width > 1),
path as (
  select d.lang, d.idx, s.lvl, s.step
  from leaves d join steps s on s.lang is not distinct from d.lang and s.idx = d.idx >> s.lvl
  union all
  select d.lang, d.idx, r.height + u.lvl, u.step
  from leaves d join subroots r on r.lang is not distinct from d.lang join upper_steps u on u.idx = r.idx >> u.lvl),
proofs as (select lang, idx, list(step order by lvl) as steps from path group by lang, idx),
folded as (
  select d.*, coalesce(p.steps, []) as steps,
         list_reduce([d.checked] || coalesce(p.steps, []),
                     lambda acc, s: sha256(case when s[1] = 'l' then s[2:] || acc else acc || s[2:] end)) as folded_root
  from leaves d left join proofs p on p.lang is not distinct from d.lang and p.idx = d.idx)
select f.doc_id, f.leaf, r.digest as subroot, u.digest as root,
       sha256(coalesce(list_aggregate(list_transform(f.steps, lambda s: s[2:]), 'string_agg', ''), '')) as proof_sha256,
       f.folded_root, f.folded_root = u.digest as verified
from folded f join subroots r on r.lang is not distinct from f.lang join upper u on u.width = 1""",
}
