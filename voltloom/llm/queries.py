"""The operators' queries with production parameters, and the SQL that states their results where SQL can."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .html_text import extract
from .merkle import manifest
from .neardup import near_duplicates
from .overlap import overlap_join
from .packing import pack
from .pieces import encode
from .quality import classify, fold, train
from .repeats import PASSAGE, PASSAGE_GRAM, remove_repeats
from .sharding import shard
from .tokens import count_tokens
from .vafile import book_text, compress
from .vectors import search, voronoi_join


def tokenizer(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.withColumn("grown_shard", F.lit(None).cast("int"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), tokenizer("word_bpe_49k.json"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), tokenizer("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", F.col("text").isNull().alias("none"))
    out = remove_repeats(docs, passages=(PASSAGE, PASSAGE_GRAM))
    n_spans, n_passages = (F.size(c).cast("long") for c in ("spans", "passages"))
    text = F.when(~F.col("none"), F.when(n_passages > 0, F.col("rest")).otherwise(F.col("text")))
    return out.select("doc_id", "n_bytes", "n_removed", n_spans.alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"), n_passages.alias("n_passages"), text.alias("text"))


def op6_one_bit_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op7_voronoi_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voronoi_join(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "class_id", "class_size")


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), tokenizer("piece_bpe_32k.model"))
    return coded.select("doc_id", "n_pieces", F.crc32("ids").alias("ids_crc32"), F.sha2(F.encode("decoded", "utf-8"), 256).alias("decoded_sha256"), "n_chunks")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scored = classify(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return scored.select("doc_id", (fold(F.col("doc_id")) == 1).alias("held_out"), "score", "predicted")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return coded.select("vec_id", "code", "error", "label_error", F.lit(hashlib.sha256(book_text(books).encode()).hexdigest()).alias("codebooks_sha256"))


def op12_overlap_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap_join(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return manifest(docs, found=F.when(tampered, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_sharding, op2_token_counts, op3_packing, op4_html_extraction, op5_suffix_dedup, op6_one_bit_codes, op7_voronoi_knn, op8_near_duplicates, op9_sentencepiece, op10_quality, op11_vector_codes, op12_overlap_join, op13_merkle)}


OP7_SQL = """
with v as (
  select row_number() over () as rid, vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as y
  from embeddings
  where vec_id is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
), s as (
  select q.rid as qr, q.vec_id as query_id, d.vec_id, d.rid as dr,
         cast(list_sum(list_transform(list_zip(q.y, d.y), lambda z: z[1] * z[2])) as bigint) as score
  from v q join v d on q.rid <> d.rid where q.vec_id % 20 = 0
), r as (select *, row_number() over (partition by qr order by score desc, vec_id, dr) as rank from s)
select query_id, cast(rank as integer) as rank, vec_id, score from r where rank <= 20
"""


def _codes_sql(rounds: int = 6) -> str:
    """Rounds of assignment (a) and new codebooks (c), one after the other."""
    sql = """
with v as (
  select row_number() over () as rid, vec_id, label, list_transform(embedding, lambda x: cast(floor(4096 * cast(x as double)) as bigint)) as y from embeddings
  where embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
), p as materialized (select rid, vec_id, part, list_slice(y, part * (len(y) // 8) + 1, (part + 1) * (len(y) // 8)) as x from v, (select unnest(range(8)) as part)),
few as (select rid, row_number() over (order by vec_id, y) - 1 as entry from v qualify entry < 16),
c0 as materialized (select part, entry, x as c from p join few using (rid))"""
    for k in range(rounds + 1):
        sql += f""",
d{k} as (select rid, part, entry, cast(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) as bigint) as d from p join c{k} using (part)),
a{k} as materialized (select rid, part, entry, d from d{k} qualify row_number() over (partition by rid, part order by d, entry) = 1)"""
        if k < rounds:
            sql += f""",
s{k} as (select part, entry, unnest(range(1, len(x) + 1)) as i, unnest(x) as x from p join a{k} using (rid, part)),
m{k} as (select part, entry, i, cast(sum(x) as bigint) as s, count(*) as n from s{k} group by all),
n{k} as (select part, entry, list((s - ((s % n) + n) % n) // n order by i) as c from m{k} group by part, entry),
c{k + 1} as materialized (select part, entry, coalesce(n{k}.c, c{k}.c) as c from c{k} left join n{k} using (part, entry))"""
    return sql + f""",
e as (select rid, string_agg(printf('%02x', entry), '' order by part) as code, cast(sum(d) as bigint) as error from a{rounds} group by rid)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error,
       (select sha256(string_agg(array_to_string(c, ','), ',' order by part, entry)) from c{rounds}) as codebooks_sha256
from e join v using (rid)"""


OP12_SQL = """
with recursive w as materialized (
  select doc_id, row_number() over () as rid, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents
), g as materialized (
  select doc_id, rid, list_distinct(case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3]) end) as s from w
), sets as materialized (select s, min(rid) as sid, len(s) as n from (select rid, list_sort(s) as s from g where len(s) > 0) group by s),
u as materialized (select sid, n, unnest(s) as x from sets),
o as (select a.sid as a, b.sid as b, a.n as na, b.n as nb, count(*) as k from u a join u b on a.x = b.x and a.sid < b.sid and 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n) group by all),
l as materialized (select a, b from o where 100 * k >= 85 * (na + nb - k)),
way as materialized (select a, b from l union all select b, a from l),
reach as (select sid as a, sid as b from sets union select r.a, e.b from reach r join way e on r.b = e.a),
root as materialized (select a as sid, min(b) as root from reach group by a),
members as materialized (select g.doc_id, g.rid, len(g.s) as n, root from g left join sets on list_sort(g.s) = sets.s left join root using (sid))
select doc_id, n as n_shingles, case when n = 0 then doc_id else min(doc_id) over (partition by root) end as component_id from members
"""


def _merkle_sql(levels: int = 30) -> str:
    """Levels of all trees one after the other: groups of one node stay as they are; 3 ** 30 leaves have 30 levels."""
    field = lambda c: f"coalesce(strlen(cast({c} as varchar)) || ':' || cast({c} as varchar), '-')"
    fields = lambda t: " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars", t))

    def tree(name: str, group: str) -> str:
        # {name}0 has {group}, q (number in the group) and h; path {name}p has {group}, q and the lists l and r of siblings by level
        w = f"(partition by {group}, q // 3 order by q)"
        out = f"{name}p0 as (select {group}, q, q as at, cast([] as varchar[]) as l, cast([] as varchar[]) as r from {name}0)"
        for k in range(levels):
            here = f"{name}{k}"
            out += f""", {here}s as materialized (select *, count(*) over (partition by {group}) as m, concat(lag(h, 2) over {w}, lag(h, 1) over {w}) as left_, concat(lead(h, 1) over {w}, lead(h, 2) over {w}) as right_ from {here}),
{name}{k + 1} as materialized (select {group}, q // 3 as q, case when any_value(m) = 1 then any_value(h) else sha256(string_agg(h, '' order by q)) end as h from {here}s group by {group}, q // 3),
{name}p{k + 1} as materialized (select p.{group}, p.q, p.at // 3 as at, case when m = 1 then l else list_append(l, left_) end as l, case when m = 1 then r else list_append(r, right_) end as r
  from {name}p{k} p join {here}s s on p.{group} is not distinct from s.{group} and p.at = s.q)"""
        return out

    return f"""
with tbl as (select list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), lambda c, i: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end)) as t),
crc as (select doc_id, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(cast(doc_id as varchar), ''), lambda x: ascii(x))), lambda c, x: xor(c // 256, t[xor(c % 256, x) + 1])), 4294967295) as c
  from (select distinct doc_id from documents where doc_id is not null), tbl),
docs as (select d.*, case when c % 2 = 0 then replace(text, chr(10), '') else text end as found from documents d left join crc using (doc_id)),
leaves as materialized (select doc_id, source, sha256({fields("text")}) as leaf, sha256({fields("found")}) as other from docs),
a as materialized (select *, row_number() over (partition by source order by doc_id nulls first, leaf, other) - 1 as q from leaves),
a0 as (select source, q, leaf as h from a), {tree("a", "source")},
b0 as (select 0 as one, source, row_number() over (order by source nulls first) - 1 as q, h as subroot, h from a{levels}), {tree("b", "one")},
paths as (select a.doc_id, a.leaf, a.other, b0.subroot, list_concat(x.l, y.l) as l, list_concat(x.r, y.r) as r from a join a{"p"}{levels} x on a.source is not distinct from x.source and a.q = x.q
  join b0 on a.source is not distinct from b0.source join bp{levels} y on y.q = b0.q),
f as (select *, (select h from b{levels}) as root, list_reduce(list_prepend(other, list_transform(list_zip(l, r), lambda z: z[1] || '|' || z[2])), lambda h, z: sha256(split_part(z, '|', 1) || h || split_part(z, '|', 2))) as folded_root from paths)
select doc_id, leaf, subroot, root, sha256(list_reduce(list_prepend('', list_transform(list_zip(l, r), lambda z: z[1] || z[2])), lambda x, z: x || z)) as proof_sha256, folded_root, folded_root = root as verified from f
"""


def oracle_sql() -> dict[str, str]:
    return {"op7_voronoi_knn": OP7_SQL, "op11_vector_codes": _codes_sql(), "op12_overlap_join": OP12_SQL, "op13_merkle": _merkle_sql()}
