"""Registered queries of the operators, each over its whole table, and their DuckDB SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import chat, interactions, langid, lines, neardup, packing, pieces, pii, resample, substrings, toxicity, vectors
from tidemark.llm.common import on_workers


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    on_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.exact_top_k(table(spark, sf_dir, "embeddings"))


def op2_block_matrix_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.nearest(table(spark, sf_dir, "embeddings"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.languages(table(spark, sf_dir, "documents"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text, and what decoding them gives back."""
    back = pieces.round_trip(table(spark, sf_dir, "documents"))
    return back.select("doc_id", "n_ids", "ids_crc32", F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substrings.dedup_substrings(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.sql("select -7L conv_id, id turn, if(id = 0, 'user', 'assistant') role, '</s>[INST] ok [/INST]' text from range(2)")
    turns = rows.union(hard).withColumn("parts", chat.text_parts(F.col("text")))
    back = chat.read_back(chat.format_conversations(turns))
    said = F.expr(r"array_join(transform(arrays_zip(roles, texts), x -> concat(x.roles, '\n', x.texts, '\n')), '')")
    loss = F.array_join("loss_texts", "")
    return back.select(
        "conv_id",
        F.size("texts").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    listed = "array_join(transform({}, x -> concat(x.kind, ':', x.start, ':', x.end)), ',')"
    base = "filter(found, x -> x.base)"
    return found.select(
        "doc_id",
        *[F.expr(f"cast(size(filter(found, x -> x.base and x.kind = '{k}')) as long)").alias(f"n_{k}") for k in pii.KINDS],
        F.sha2(F.expr(listed.format(base)), 256).alias("base_sha256"),
        F.expr(listed.format("found")).alias("spans"),
    )


def op12_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {
    "op1_exact_top_k": op1_exact_top_k,
    "op2_block_matrix_neighbours": op2_block_matrix_neighbours,
    "op3_language_id": op3_language_id,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_line_dedup": op7_line_dedup,
    "op8_chat_format": op8_chat_format,
    "op9_minhash_near_dedup": op9_minhash_near_dedup,
    "op10_toxicity": op10_toxicity,
    "op11_pii": op11_pii,
    "op12_filter_interactions": op12_filter_interactions,
    "op13_importance_resampling": op13_importance_resampling,
}


_TEXTS = "select coalesce(doc_id, 9223372036854775807) as id, doc_id, coalesce(text, '') as text, row_number() over () as r from documents"

_VECTORS = "v as (select vec_id, embedding::double[] as v from embeddings where vec_id is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)"

ORACLE = {
    "op1_exact_top_k": f"""
with {_VECTORS},
i as (select vec_id, list_transform(v, lambda x: floor(256 * x)) as v from v),
p as (select q.vec_id as query_id, c.vec_id, list_dot_product(q.v, c.v)::bigint as score from i q join i c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from p)
select query_id, rank, vec_id, score from r where rank <= 5""",
    "op2_block_matrix_neighbours": f"""
with {_VECTORS},
n as (select * from v where len(list_filter(v, lambda x: x <> 0)) > 0),
p as (select q.vec_id as query_id, c.vec_id, list_dot_product(q.v, c.v) as score from n q join n c on q.vec_id <> c.vec_id where q.vec_id % 20 = 0),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from p)
select query_id, rank, vec_id, score from r where rank <= 20""",
    "op5_substring_dedup": f"""
with d as ({_TEXTS}),
w as (select id, doc_id, r, list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as ws from d),
s as (select id, r, unnest(range(len(ws) - 19)) as s, ws from w where len(ws) >= 20),
k as (select id, r, s, array_to_string(ws[s + 1:s + 20], ' ') as k from s),
f as (select k, min({{'id': id, 's': s}}) as f from k group by k),
g as (select distinct r, unnest(range(s, s + 20)) as pos from k join f on k.k = f.k where (k.id, k.s) > (f.f.id, f.f.s)),
u as (select r, unnest(range(len(ws))) as pos, unnest(ws) as word from w),
j as (select u.r, u.pos, word, g.r is not null as gone from u left join g on u.r = g.r and u.pos = g.pos),
a as (select r, count(*) as n, count(*) filter (gone) as n_gone, string_agg(word, ' ' order by pos) filter (not gone) as kept from j group by r)
select doc_id, coalesce(n, 0) as n_words, coalesce(n_gone, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256 from w left join a on w.r = a.r""",
    "op7_line_dedup": f"""
with d as ({_TEXTS}),
s as (select r, id, string_split(text, chr(10)) as ls from d),
l as (select r, id, unnest(ls) as line, unnest(range(len(ls))) as pos from s),
k as (select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from l),
f as (select key, min(id) as first from k where length(key) >= 10 group by key),
j as (select k.r, pos, line, coalesce(k.id > f.first, false) as lost from k left join f on k.key = f.key)
select any_value(d.doc_id) as doc_id, count(*) as n_lines, count(*) filter (lost) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not lost), '')) as kept_sha256
from j join d on d.r = j.r group by j.r""",
    "op8_chat_format": """
with t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, i, case when i = 0 then 'user' else 'assistant' end, '</s>[INST] ok [/INST]' from range(2) x(i)),
e as (select *, length(role) + length(text) + length(regexp_replace(role, '[^~<[]', '', 'g')) + length(regexp_replace(text, '[^~<[]', '', 'g')) as escaped from t)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  sum(escaped + 8 + 1 + 8)::bigint as formatted_chars
from e group by conv_id""",
    "op9_minhash_near_dedup": f"""
with recursive d as ({_TEXTS}),
w as (select id, r, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as ws from d),
s as (select id, r, list_distinct(case when len(ws) > 1 then list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) else ws end) as s from w),
p as (select id, r, len(s) as n, unnest(s) as x from s),
e as (select a.r as a, b.r as b from p a join p b on a.x = b.x and a.r <> b.r and 100 * a.n >= 80 * b.n and 100 * b.n >= 80 * a.n
  group by a.r, b.r, a.n, b.n having 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach(r, x) as (select r, r from s union select reach.r, e.b from reach join e on reach.x = e.a),
c as (select reach.r, min(s.id) as c from reach join s on reach.x = s.r group by reach.r)
select nullif(s.id, 9223372036854775807) as doc_id, len(s.s) as n_shingles, nullif(c.c, 9223372036854775807) as component_id, s.id = c.c as kept
from s join c on s.r = c.r""",
    "op12_filter_interactions": f"""
with d as ({_TEXTS}),
s as (select r, coalesce(source, '') as part from (select source, row_number() over () as r from documents)),
w as (select *, list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as ws from d),
l as (select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by doc_id),
m as (select part, coalesce(good, false) as good, coalesce(toxic, false) as toxic,
    [len(ws) < 200, 100 * len(list_distinct(ws)) < 50 * len(ws), 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text),
     regexp_matches(text, '[#$%&*|]'), id > min(id) over (partition by text)] as fails
  from w join s on w.r = s.r left join l on w.doc_id = l.doc_id),
x as (select * from (values ('A', 1), ('B', 2), ('C', 3), ('D', 4), ('E', 5)) v(letter, i)),
o as (select [a.i, b.i, c.i, d.i, e.i] as ord, a.letter || b.letter || c.letter || d.letter || e.letter as filter_order
  from x a, x b, x c, x d, x e where len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
g as (select part, fails, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic from m group by part, fails),
t as (select part, fails, n, good, toxic, filter_order, ord, unnest(range(1, 6))::int as step from g, o),
f as (select *, ord[step] as i, fails[ord[step]] as fail, list_bool_or(list_transform(ord[1:step], lambda j: fails[j])) as out_by,
    coalesce(list_bool_or(list_transform(ord[1:step - 1], lambda j: fails[j])), false) as out_before, list_sum(list_transform(fails, lambda b: b::int)) as n_fails from t),
a as (select part, filter_order, step, i, coalesce(sum(n) filter (not out_by), 0)::bigint as kept, coalesce(sum(n) filter (fail and not out_before), 0)::bigint as removed,
    coalesce(sum(n) filter (fail and out_before), 0)::bigint as redundant, coalesce(sum(n) filter (fail and n_fails = 1), 0)::bigint as unique_fails,
    coalesce(sum(good) filter (fail and not out_before), 0)::bigint as good_lost, coalesce(sum(toxic) filter (fail and not out_before), 0)::bigint as toxic_lost
  from f group by part, filter_order, step, i)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, sum(removed) over (partition by part, i)::bigint as shapley from a""",
    "op13_importance_resampling": f"""
with d as ({_TEXTS}),
b as (select 'd' as kind, r, doc_id, id, text from d union all select 'b', row_number() over (), null, null, coalesce(text, '') from benchmark),
w as (select kind, r, doc_id, id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') as ws from b),
s as (select kind, r, unnest(ws) as f from w
  union all select kind, r, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) from w
  union all select kind, r, unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) from w),
bits as (select list(list_reduce(range(8), lambda c, i: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, b) order by b) as crc from (select unnest(range(256)) as b)),
u as (select f, hex(f) as h from (select distinct f from s)),
k as (select f, xor(list_reduce(range(len(h) // 2), lambda c, i: xor(c >> 8, crc[1 + (xor(c, ('0x' || h[2 * i + 1:2 * i + 2])::bigint) & 255)]), 4294967295::bigint), 4294967295) % 10000 as bucket from u, bits),
c as (select bucket, count(*) filter (kind = 'd') as s, count(*) filter (kind = 'b') as t from s join k on s.f = k.f group by bucket),
n as (select sum(s) as s, sum(t) as t from c),
g as (select bucket, floor(1000 * ln((c.t + 1)::double * (n.s + 10000) / ((c.s + 1)::double * (n.t + 10000))))::bigint as gain from c, n),
v as (select r, count(*) as n, sum(gain)::bigint as weight from s join k on s.f = k.f join g on k.bucket = g.bucket where kind = 'd' group by r),
e as (select w.doc_id, w.id, len(ws) as n_words, coalesce(n, 0)::bigint as n_features, coalesce(weight, 0)::bigint as weight,
    (('0x' || substr(sha256('42:' || coalesce(w.doc_id::varchar, '')), 1, 8))::bigint + 0.5::double) / 4294967296 as u from w left join v on w.r = v.r where kind = 'd'),
z as (select *, weight + floor(-1000 * ln(-ln(u)))::bigint as score from e),
q as (select *, case when n_words >= 20 then row_number() over (partition by n_words >= 20 order by score desc, id, n_features desc) end as place from z)
select doc_id, n_features, weight, score, case when place <= 5 * (select count(*) from q where n_words >= 20) // 100 then place end as rank from q""",
}
