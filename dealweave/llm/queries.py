"""Registered queries of the numbered operators, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontamination, html_extraction, language_id, packing, quality, sentencepiece_codec, sharding, simhash_dedup, spelling_variants, suffix_dedup, topk_search, toxicity, whitening
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return wrap


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(
    "op1_decontamination",
    f"""
    with i as (select cast(item_id as varchar) as item, {_WORDS} as w from benchmark),
    iw as (
        select distinct item, n, array_to_string(w[p:p + n - 1], ' ') as k
        from (select item, w, least(10, len(w)) as n, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) as p from i where len(w) > 0) x
    ), d as (select row_number() over () as r, doc_id, {_WORDS} as w from documents),
    dw as (
        select r, n, p, array_to_string(w[p:p + n - 1], ' ') as k
        from (select r, w, n, unnest(generate_series(1, len(w) - n + 1)) as p from d, (select distinct n from iw) y where len(w) >= n) x
    ), hits as (select r, p, n, item from dw join iw using (n, k)),
    words as (select r, count(distinct q) as n_hit from (select r, unnest(generate_series(p, p + n - 1)) as q from hits) x group by r),
    items as (select r, list_sort(list_filter(list(distinct item), lambda x: x is not null)) as own from hits group by r)
    select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(len(own), 0) as n_items, sha256(coalesce(array_to_string(own, ','), '')) as items_sha256,
        coalesce(n_hit, 0) > 0 as contaminated
    from d left join words using (r) left join items using (r)
    """,
)
def op1(spark, sf_dir):
    return decontamination.op1(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op2_language_id")
def op2(spark, sf_dir):
    return language_id.op2(table(spark, sf_dir, "documents"))


@query("op3_html_extraction")
def op3(spark, sf_dir):
    return html_extraction.op3(table(spark, sf_dir, "pages"))


@query("op4_sharding")
def op4(spark, sf_dir):
    return sharding.op4(table(spark, sf_dir, "documents"))


@query("op5_sentencepiece")
def op5(spark, sf_dir):
    return sentencepiece_codec.op5(table(spark, sf_dir, "documents"))


@query("op6_toxicity")
def op6(spark, sf_dir):
    return toxicity.op6(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op7_quality")
def op7(spark, sf_dir):
    return quality.op7(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query(
    "op8_topk_search",
    """
    with v as (
        select vec_id, [floor(1024 * x::double) for x in embedding] as e from embeddings
        where embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0
    ), s as (
        select q.vec_id as query_id, d.vec_id, list_inner_product(q.e, d.e)::bigint as score
        from v q join v d on q.vec_id <> d.vec_id where q.vec_id % 100 = 0
    )
    select query_id, (row_number() over (partition by query_id order by score desc, vec_id))::int as rank, vec_id, score
    from s qualify row_number() over (partition by query_id order by score desc, vec_id) <= 10
    """,
)
def op8(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return topk_search.search(vectors, vectors.filter(F.col("vec_id") % 100 == 0))


@query("op9_suffix_dedup")
def op9(spark, sf_dir):
    return suffix_dedup.op9(table(spark, sf_dir, "documents"))


@query("op10_simhash")
def op10(spark, sf_dir):
    return simhash_dedup.op10(table(spark, sf_dir, "documents"))


@query("op11_packing")
def op11(spark, sf_dir):
    return packing.op11(table(spark, sf_dir, "documents"))


@query("op12_whitening")
def op12(spark, sf_dir):
    return whitening.op12(table(spark, sf_dir, "embeddings"))


# A checksum a byte at a time, words one edit apart by what is left when a character goes, and forms followed to their ends.
_OP13 = r"""
with recursive crc(i, k, v) as (
    select i, 0, i from (select unnest(generate_series(0, 255))::bigint as i) s
    union all select i, k + 1, case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end from crc where k < 8
), crcs as (select list(v order by i) as t from crc where k = 8),
runs as (
    select doc_id, run, count(*) as n from (
        select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) as run from documents) x group by doc_id, run
), hashed as (
    select r.run, r.n, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(regexp_replace(hex(encode(coalesce(doc_id::varchar, '') || ':' || run)), '(..)', '\1 ', 'g'), ' ')[:-2], lambda h: ('0x' || h)::bigint)),
        lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) as h
    from runs r, crcs
), words as (
    select word, sum(n)::bigint as n from (
        select case when h % 97 = 0 then substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end as word, n from hashed) z
    where length(word) >= 5 group by word having sum(n) >= 3
), cuts as (
    select word, i, substr(word, 1, i - 1) || substr(word, i + 1) as rest from (select word, unnest(generate_series(1, length(word))) as i from words) c
), near as (
    select a.word, a.other, w.n as other_n from (
        select a.word, b.word as other from cuts a join cuts b on a.i = b.i and a.rest = b.rest and a.word <> b.word
        union select c.word, w.word from cuts c join words w on w.word = c.rest
        union select w.word, c.word from cuts c join words w on w.word = c.rest) a join words w on w.word = a.other
), best as (
    select word, count(*) as n_near, arg_min(other, (-other_n, encode(other))) as other, max(other_n) as other_n from near group by word
), forms as (
    select w.word, w.n, coalesce(n_near, 0) as n_near, case when other_n >= 2 * w.n then other end as form, case when other_n >= 2 * w.n then other_n end as form_n from words w left join best using (word)
), walk(word, here) as (select word, word from forms union all select w.word, f.form from walk w join forms f on f.word = w.here where f.form is not null),
ends as (select w.word, w.here as root from walk w join forms f on f.word = w.here where f.form is null)
select f.word, form, root, n, n_near, form_n from forms f join ends e on e.word = f.word
"""


@query("op13_spelling_variants", _OP13)
def op13(spark, sf_dir):
    return spelling_variants.op13(table(spark, sf_dir, "documents"))
