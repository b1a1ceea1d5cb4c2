"""Registered queries of the text operators, over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evalspark.llm import (
    dedup, language, merkle, mixing, packing, phrases, pii, quality, secret_scan, sharding, token_files, topk, warc,
)
from evalspark.llm.common import table


def op1_bag_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with the smallest id of its class of near-duplicates."""
    return dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op2_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = mixing.mixed(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "size", "source_size", "target", "taken")


def op3_elias_fano_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = token_files.token_file_round_trip(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "start", "n_tokens", "ids_crc32")


def op4_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonyms(docs).select("doc_id", "text", "n_values", "kinds")


def op5_tiered_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op7_divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = quality.quality(table(spark, sf_dir, "documents"))
    return got.drop("js_chars", "js_words")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


def op9_hypergeometric_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    measured = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    return sharding.sharded(measured).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_histogram_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op11_secret_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digests(secret_scan.secrets(table(spark, sf_dir, "documents")))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all rows; of those with an even checksum a text without line breaks is checked."""
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    found_later = F.when(tampered, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    fields = ("doc_id", "source", "lang", "n_chars")
    suspects = docs.select(
        "doc_id",
        "source",
        merkle.leaf(*fields, "text").alias("leaf"),
        merkle.leaf(*fields, found_later).alias("claimed"),
    )
    return merkle.checked(suspects).drop("source")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_bag_minhash,
        op2_pareto_mix,
        op3_elias_fano_files,
        op4_feistel_pseudonyms,
        op5_tiered_packing,
        op6_language,
        op7_divergence_rules,
        op8_warc,
        op9_hypergeometric_shards,
        op10_histogram_top_k,
        op11_secret_layers,
        op12_collocations,
        op13_merkle_manifest,
    )
}

#: Bits of a hexadecimal SHA-1, 20 at a time, in the alphabet of base 32.
_BASE32 = """array_to_string(list_transform(range(0, 40, 5), lambda i:
    array_to_string(list_transform([15, 10, 5, 0], lambda b:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               1 + ((('0x' || substr(h, (i + 1)::int, 5))::int >> b) & 31), 1)), '')), '')"""

OP8_SQL = f"""
with page as (
    select page_id, coalesce(html, '') as body, sha1(coalesce(html, '')) as h from pages
), first as (
    select h, max(page_id) as top from page group by h
)
select page_id, strlen(body) as payload_bytes, {_BASE32} as payload_digest,
       case when page_id = top then 'response' else 'revisit' end as record_type,
       case when page_id <> top then top end as refers_to
from page join first using (h)
"""

OP10_SQL = """
with v as (
    select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as w
    from embeddings
    where embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
    select q.vec_id as query_id, c.vec_id,
           list_sum(list_transform(list_zip(q.w, c.w), lambda p: p[1] * p[2]))::bigint as score
    from v q join v c on q.vec_id % 100 = 0 and c.vec_id <> q.vec_id
)
select query_id, rank::int as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank
      from scored)
where rank <= 10
"""



def _js(p: str, q: str) -> str:
    """Jensen-Shannon distance of two lists of counts, rounded as the operator does."""

    def part(x: str, y: str) -> str:
        return f"case when {x} > 0 then {x} * log2(2 * {x} / ({x} + {y})) else 0 end"

    x, y = (f"({v}[i] / nullif(list_sum({v}), 0)::double)" for v in (p, q))
    terms = f"list_transform(range(1, len({p}) + 1), lambda i: ({part(x, y)} + {part(y, x)}) / 2)"
    return f"round(sqrt(greatest(0, list_sum({terms}))), 6)"


_COUNTS = [f"len(regexp_extract_all(text, '{c}'))" for c in quality.CLASSES]

OP7_SQL = f"""
with d as (
    select doc_id, lang, coalesce(text, '') as text,
           list_filter(regexp_split_to_array(coalesce(text, ''), '{quality.SPACES}+'), lambda x: x <> '') as w
    from documents
), m as (
    select *, [{", ".join(_COUNTS)}, length(text) - {" - ".join(_COUNTS)}] as classes,
           list_filter(list_transform(w, lambda x: lower(x)), lambda x: length(x) <= {quality.COMMON_CHARS}) as short,
           list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines
    from d
), x as (
    select lang, classes, short, len(w) as n from m where lang is not null
    union all select null, classes, short, len(w) from m
), totals as (
    select lang, [{", ".join(f"sum(classes[{i + 1}])::bigint" for i in range(len(_COUNTS) + 1))}] as rc,
           sum(n)::bigint as n
    from x group by lang
), top as (
    select lang, key, count(*) as n,
           row_number() over (partition by lang order by count(*) desc, key) as place
    from (select lang, unnest(short) as key from x) group by lang, key
    qualify place <= {quality.COMMON}
), common as (
    select lang, list(key order by place) as rw, list(n order by place) as rn, sum(n)::bigint as s
    from top group by lang
), refs as (
    select t.lang, rc, coalesce(rw, []) as rw, list_concat(coalesce(rn, []), [n - coalesce(s, 0)]) as rn
    from totals t left join common c on t.lang is not distinct from c.lang
), h as (
    select m.*, rc, rw, rn, list_filter(short, lambda v: list_contains(rw, v)) as known
    from m left join refs r on m.lang is not distinct from r.lang
), j as (
    select doc_id, w, lines, text, {_js("classes", "rc")} as js_chars, {_js("counts", "rn")} as js_words
    from (select *, list_concat(list_transform(rw, lambda r: len(list_filter(known, lambda v: v = r))),
                                [len(w) - len(known)]) as counts from h)
), windows as (
    select doc_id, i, count(*) over (partition by doc_id, w[i], w[i + 1], w[i + 2]) as n
    from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from d)
), repeated as (
    select doc_id, count(distinct i + k) as n
    from windows, (values (0), (1), (2)) as t(k) where n > 1 group by doc_id
), base as (
    select j.*, len(w) as n_words, coalesce(r.n, 0) as n_repeat_words from j left join repeated r using (doc_id)
), judged as (
    select *, n_words < {quality.LEAST_WORDS}
              or 100 * n_repeat_words > {quality.MOST_REPEATED_PERCENT} * n_words as base_failed
    from base
)
select doc_id, n_words, length(array_to_string(w, '')) as word_chars,
       len(regexp_extract_all(text, '{quality.SYMBOLS}')) as n_symbols,
       len(lines) - len(list_distinct(lines)) as n_dup_lines, n_repeat_words, base_failed,
       not base_failed
       and not coalesce(length(text) >= {quality.LEAST_CHARS} and js_chars > {quality.MOST_CHARS_DISTANCE}, false)
       and not coalesce(n_words >= {quality.LEAST_WORDS_FOR_WORDS}
                        and js_words > {quality.MOST_WORDS_DISTANCE}, false) as kept
from judged
"""


OP12_SQL = f"""
with pieces as (
    select coalesce(lang, 'und') as lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as w
    from (select lang, unnest(regexp_split_to_array(
              translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[.,;:!?\\x0A-\\x0D]')) as piece from documents)
), totals as (
    select lang, sum(len(w))::bigint as n from pieces group by lang
), grams as (
    select lang, k, w[i:i + k - 1] as words
    from (select lang, w, k, unnest(range(1, len(w) - k + 2)) as i
          from pieces, (values {", ".join(f"({k})" for k in range(1, phrases.LONGEST + 1))}) as t(k))
), often as (
    select lang, k, words, count(*)::bigint as f from grams group by all having count(*) >= {phrases.LEAST}
), dropped as (
    select distinct s.lang, s.words
    from (select lang, f, k, words, unnest(range(2, k)) as size from often where k > 2) as g,
         lateral (select unnest(range(1, g.k - g.size + 2)) as i) as p
    join often s on s.lang = g.lang and s.words = g.words[i:i + g.size - 1] and g.f >= s.f
), cuts as (
    select c.lang, c.words, c.f as a, n, cut, x.f as l, y.f as r,
           (1000::hugeint * c.f * n) // (x.f::hugeint * y.f) as score
    from (select *, unnest(range(1, k)) as cut from often where k > 1) as c
    join totals using (lang)
    join often x on x.lang = c.lang and x.words = c.words[1:cut]
    join often y on y.lang = c.lang and y.words = c.words[cut + 1:]
    where not exists (select 1 from dropped d where d.lang = c.lang and d.words = c.words)
), worst as (
    select * from cuts qualify row_number() over (partition by lang, words order by score, cut) = 1
), ranked as (
    select *, array_to_string(words, ' ') as phrase from worst
)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank,
       phrase, a, l, r, n, score::bigint as score
from ranked qualify rank <= {phrases.TOP}
"""


def _leaf_sql(text: str) -> str:
    values = ("doc_id", "source", "lang", "n_chars", text)
    return "sha256(" + " || ".join(f"coalesce(strlen({v}::varchar) || ':' || {v}::varchar, '-')" for v in values) + ")"


#: Checksum (CRC-32) of a short text of ASCII characters, bit by bit.
_CRC32 = """xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(1, length(s) + 1), lambda i: ascii(substr(s, i, 1))::bigint)),
    lambda c, x: list_reduce([xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0],
                             lambda a, b: xor(a >> 1, 3988292384 * (a & 1)))))"""

OP13_SQL = f"""
with recursive named as (
    select *, doc_id::varchar as s from documents
), suspect as (
    select *, case when {_CRC32} % 2 = 0 then replace(text, chr(10), '') else text end as later from named
), hashed as (
    select doc_id, source, {_leaf_sql("text")} as leaf, {_leaf_sql("later")} as claimed from suspect
), leaves as (
    select *, row_number() over () as rid, count(*) over (partition by source) as n,
           row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as i
    from hashed
), tree(source, level, i, n, h) as (
    select source, 0, i, n, leaf from leaves
    union all
    select source, level + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' order by i))
    from tree where n > 1 group by source, level, i // 3, n
), subroots as (
    select source, h as subroot, row_number() over (order by source nulls first) - 1 as k, count(*) over () as sources
    from tree where n = 1
), top(level, i, n, h) as (
    select 0, k, sources, subroot from subroots
    union all
    select level + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' order by i))
    from top where n > 1 group by level, i // 3, n
), placed as (
    select l.*, s.subroot, s.k from leaves l join subroots s on l.source is not distinct from s.source
), near as (
    select p.rid, 0 as part, t.level, t.i, t.h, p.i // (3 ** t.level)::bigint as own
    from placed p join tree t on p.source is not distinct from t.source
     and t.n > 1 and t.i // 3 = p.i // (3 ** (t.level + 1))::bigint
    union all
    select p.rid, 1, t.level, t.i, t.h, p.k // (3 ** t.level)::bigint
    from placed p join top t on t.n > 1 and t.i // 3 = p.k // (3 ** (t.level + 1))::bigint
), runs as (
    select rid, row_number() over (partition by rid order by part, level) as step,
           coalesce(string_agg(h, '' order by i) filter (where i < own), '') as before,
           coalesce(string_agg(h, '' order by i) filter (where i > own), '') as behind
    from near group by rid, part, level
), proofs as (
    select rid, string_agg(before || behind, '' order by step) as siblings, max(step) as steps from runs group by rid
), fold(rid, step, cur) as (
    select rid, 0::bigint, claimed from leaves
    union all
    select f.rid, r.step, sha256(r.before || f.cur || r.behind)
    from fold f join runs r on r.rid = f.rid and r.step = f.step + 1
), ends as (
    select p.*, coalesce(q.siblings, '') as siblings, f.cur as folded_root, t.h as root
    from placed p left join proofs q using (rid)
    join fold f on f.rid = p.rid and f.step = coalesce(q.steps, 0)
    join top t on t.n = 1
)
select doc_id, leaf, subroot, root, sha256(siblings) as proof_sha256, folded_root, folded_root = root as verified
from ends
"""

ORACLE: dict[str, str] = {
    "op7_divergence_rules": OP7_SQL,
    "op8_warc": OP8_SQL,
    "op10_histogram_top_k": OP10_SQL,
    "op12_collocations": OP12_SQL,
    "op13_merkle_manifest": OP13_SQL,
}
