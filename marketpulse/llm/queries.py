"""The registered queries of the text operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketpulse.llm import (decontaminate, hard_negatives, html_text, jaccard_join, language_id, license_scan, line_dedup, merkle,
                             sentence_pieces, spelling_variants, substring_dedup, token_files, toxicity)
from marketpulse.sources.tables import read_table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def put(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return put


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").select("doc_id", "text")


OP4_SQL = r"""
with doc as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
item as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
wins as (select item_id, least(len(w), 10) as n, unnest(range(1, greatest(len(w) - 8, 2))) as i, w
         from item where len(w) > 0),
keys as (select distinct item_id, n, array_to_string(w[i: i + n - 1], ' ') as k from wins),
sizes as (select distinct n from keys),
spot as (select doc_id, n, w, unnest(range(1, len(w) - n + 2)) as i from doc, sizes where len(w) >= n),
hit as (select doc_id, item_id, i, spot.n from spot join keys on keys.n = spot.n
        and keys.k = array_to_string(spot.w[i: i + spot.n - 1], ' ')),
words as (select doc_id, count(distinct p) as n_hit
          from (select doc_id, unnest(range(i, i + n)) as p from hit) group by 1),
items as (select doc_id, count(*) as n_items, string_agg(id, ',' order by id) as ids
          from (select distinct doc_id, item_id::varchar as id from hit) group by 1)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
       coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(ids, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 as contaminated
from doc left join words using (doc_id) left join items using (doc_id)"""


OP2_SQL = r"""
with recursive doc as (select doc_id, regexp_extract_all(translate(coalesce(text, ''),
       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
sh as (select doc_id, unnest(case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
         else list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i: i + 3], ' ')) end) as s
       from doc),
sets as (select distinct doc_id, s from sh),
size as (select doc_id, count(*) as n from sets group by 1),
ordered as (select doc_id, s, row_number() over (partition by doc_id order by df, s) as r
            from sets join (select s, count(*) as df from sets group by 1) using (s)),
head as (select doc_id, s, n from ordered join size using (doc_id) where r <= n - (85 * n + 99) // 100 + 1),
cand as (select distinct a.doc_id as a, b.doc_id as b, a.n as na, b.n as nb from head a join head b
         on a.s = b.s and a.doc_id < b.doc_id and 100 * a.n >= 85 * b.n and 100 * b.n >= 85 * a.n),
met as (select a, b, na, nb, count(*) as m from cand join sets x on x.doc_id = a
        join sets y on y.doc_id = b and y.s = x.s group by all),
link as (select a, b from met where 100 * m >= 85 * (na + nb - m)),
both_ as (select a, b from link union all select b, a from link),
reach as (select a, b from both_ union select r.a, e.b from reach r join both_ e on r.b = e.a)
select doc_id, coalesce(n, 0)::bigint as n_shingles, least(doc_id, coalesce(c, doc_id))::bigint as component_id
from documents left join size using (doc_id)
left join (select a as doc_id, min(b) as c from reach group by 1) using (doc_id)"""


@query("op2_jaccard_join", OP2_SQL)
def op2(spark, sf_dir):
    return jaccard_join.near_duplicates(documents(spark, sf_dir))


@query("op4_decontaminate", OP4_SQL)
def op4(spark, sf_dir):
    hits = decontaminate.contamination(documents(spark, sf_dir),
                                       read_table(spark, sf_dir, "benchmark"))
    return hits.select("doc_id", "n_words", "n_hit", "n_items",
                       F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
                       (F.col("n_hit") > 0).alias("contaminated"))


OP7_SQL = r"""
with doc as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
wins as (select doc_id, w, unnest(range(1, len(w) - 18)) as i from doc where len(w) >= 20),
again as (select doc_id, i from (select doc_id, i, row_number() over (
            partition by array_to_string(w[i: i + 19], ' ') order by doc_id, i) as nth from wins) where nth > 1),
gone as (select distinct doc_id, unnest(range(i, i + 20)) as p from again),
left_ as (select a.doc_id, string_agg(word, ' ' order by p) as kept, count(*) as n
          from (select doc_id, unnest(w) as word, generate_subscripts(w, 1) as p from doc) a
          anti join gone using (doc_id, p) group by 1)
select doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n, 0))::bigint as n_removed,
       sha256(coalesce(kept, '')) as kept_sha256
from doc left join left_ using (doc_id)"""


@query("op7_substring_dedup", OP7_SQL)
def op7(spark, sf_dir):
    kept = substring_dedup.remove_repeats(documents(spark, sf_dir))
    return kept.select("doc_id", "n_words", "n_removed",
                       F.sha2("kept", 256).alias("kept_sha256"))


def tokenizer_file(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query("op9_token_files")
def op9(spark, sf_dir):
    return token_files.read_documents(
        token_files.write(documents(spark, sf_dir), tokenizer_file("word_bpe_49k.json")))


@query("op8_merkle")
def op8(spark, sf_dir):
    return merkle.edit_fingerprints(documents(spark, sf_dir))


@query("op3_language_id")
def op3(spark, sf_dir):
    return language_id.identify(read_table(spark, sf_dir, "documents"))


OP1_SQL = r"""
with doc as (select doc_id, case when coalesce(text, '') = '' then [] else string_split(text, chr(10)) end as l
             from documents),
line as (select doc_id, unnest(l) as line, generate_subscripts(l, 1) as p from doc),
seq as (select doc_id, list(trim(line, ' ') order by p) as s, list(p order by p) as ps
        from line where trim(line, ' ') <> '' group by 1),
wins as (select doc_id, s, ps, unnest(range(1, len(s) - 1)) as i from seq where len(s) >= 3),
again as (select doc_id, ps, i from (select doc_id, ps, i, row_number() over (
            partition by s[i: i + 2] order by doc_id, i) as nth from wins) where nth > 1),
gone as (select distinct doc_id, unnest(ps[i: i + 2]) as p from again),
rest as (select doc_id, string_agg(line, chr(10) order by p) as kept, count(*) as n
         from line anti join gone using (doc_id, p) group by 1)
select doc_id, len(l)::bigint as n_lines, (len(l) - coalesce(n, 0))::bigint as n_removed,
       sha256(coalesce(kept, '')) as kept_sha256
from doc left join rest using (doc_id)"""


@query("op1_line_dedup", OP1_SQL)
def op1(spark, sf_dir):
    kept = line_dedup.dedup_lines(documents(spark, sf_dir))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op6_license_scan", license_scan.sql())
def op6(spark, sf_dir):
    return license_scan.scan(documents(spark, sf_dir))


@query("op5_html_text")
def op5(spark, sf_dir):
    return html_text.extract(read_table(spark, sf_dir, "pages"))


@query("op10_sentence_pieces")
def op10(spark, sf_dir):
    coded = sentence_pieces.encode(documents(spark, sf_dir), tokenizer_file("piece_bpe_32k.model"))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_ids"),
                        F.xxhash64("ids").alias("ids_xxhash64"), "round_trip")


OP13_SQL = """
with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                  list_transform(embedding, lambda x: floor(256 * x::double)) as v
           from embeddings where label is not null and embedding is not null
           and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
met as (select a.vec_id as anchor_id, b.vec_id as id, a.label = b.label as same,
               list_inner_product(a.v, b.v)::bigint as score
        from v a join v b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
pos as (select * from (select anchor_id, id, score, row_number() over (
          partition by anchor_id order by score desc, id) as nth from met where same) where nth <= 5)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score
from (select p.anchor_id, p.id as positive_id, m.id as negative_id, p.score as positive_score, m.score as negative_score,
             row_number() over (partition by p.anchor_id, p.id order by m.score desc, m.id) as rank
      from pos p join met m on m.anchor_id = p.anchor_id and not m.same
      and 80 * p.score <= 100 * m.score and m.score <= p.score) where rank <= 5"""


@query("op13_hard_negatives", OP13_SQL)
def op13(spark, sf_dir):
    key, label = F.col("vec_id"), F.col("label")
    return hard_negatives.mine(read_table(spark, sf_dir, "embeddings"),
                               label=F.when(key % 7 == 0, (label + 1) % 10).otherwise(label), anchors=key % 100 == 0)


OP12_SQL = r"""
with recursive crc as (select i, 0 as k, i as c from (select unnest(range(256)) as i)
       union all select i, k + 1, case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from crc where k < 8),
tab as (select list(c order by i) as t from crc where k = 8),
run as (select doc_id, w, count(*) as n from (select doc_id, unnest(regexp_extract_all(translate(text,
          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) as w
          from documents) group by all),
named as (select w, n, hex(encode(doc_id || ':' || w)) as x from run),
hashed as (select w, n, xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(
          range(len(x) // 2), lambda j: ('0x' || x[2 * j + 1: 2 * j + 2])::bigint)),
          lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) as h from named, tab),
word as (select case when h % 97 = 0 then w[: h % len(w)] || w[h % len(w) + 2:] else w end as word, sum(n)::bigint as n
         from hashed group by 1 having len(word) >= 5 and sum(n) >= 3),
cut as (select word, n, i, word[: i - 1] || word[i + 1:] as rest
        from (select word, n, unnest(range(1, len(word) + 1)) as i from word)),
pair as (select a.word, b.word as other, b.n as m from cut a join cut b
           on a.i = b.i and a.rest = b.rest and a.word <> b.word
         union select a.word, b.word, b.n from cut a join word b on a.rest = b.word
         union select b.word, a.word, a.n from cut a join word b on a.rest = b.word),
best as (select word, count(*) as n_near, first(other order by m desc, other) as other, max(m) as m from pair group by 1),
form as (select word, n, coalesce(n_near, 0) as n_near, case when m >= 2 * n then other end as form,
                case when m >= 2 * n then m end as form_n from word left join best using (word)),
walk as (select word, word as at from form union all
         select walk.word, form.form from walk join form on form.word = walk.at where form.form is not null),
last_ as (select walk.word, walk.at as root from walk join form on form.word = walk.at where form.form is null)
select word, form, root, n, n_near, form_n from form join last_ using (word)"""


@query("op12_spelling_variants", OP12_SQL)
def op12(spark, sf_dir):
    return spelling_variants.group(documents(spark, sf_dir))


@query("op11_toxicity")
def op11(spark, sf_dir):
    return toxicity.judge(documents(spark, sf_dir), read_table(spark, sf_dir, "labels"))
