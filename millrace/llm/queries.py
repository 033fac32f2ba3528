"""The registered queries of the operators, each beside its DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import binary, chat, collocations, embeddings, exact, jaccard, licences, lm, mixing, pieces, quality, secrets, trie

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[build.__name__] = build
        if sql is not None:
            SQL[build.__name__] = sql.strip()
        return build
    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(id_col: str = "doc_id"):
    """The fold of a document, 0 to 4, by its id as text."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5


def quality_model(spark: SparkSession, folder: str) -> quality.QualityModel:
    learned = table(spark, folder, "labels").filter(fold() != 0)
    return quality.fit(table(spark, folder, "documents"), learned)


QUALITY_FROM = 0.3
LM_ORDER = 3


@query("""
with d as (select doc_id, coalesce(text, '') as text from documents)
select doc_id, max(doc_id) over g as keep_id, count(*) over g as group_size,
       doc_id = max(doc_id) over g as kept, sha256(text) as text_sha256
from d window g as (partition by text)
""")
def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.exact_dedup(table(spark, folder, "documents"), digests=True)


@query(r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
sized as (select *, replace(replace(text, '\', '\\'), '<|', '<\|') as body from turns)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, body)) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, body) filter (where role = 'assistant'), '')) as loss_sha256,
       cast(sum(12 + length(role) + 1 + length(body) + 10 + 1) as bigint) as formatted_chars
from sized group by conv_id
""")
def op5_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    given = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = chat.END + chat.START + "assistant ok"
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    turns = given.unionByName(probe).withColumn("parts", chat.text_part(F.col("text")))
    read = chat.format_chats(turns).select(
        "conv_id", F.length("formatted").cast("long").alias("formatted_chars"),
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_spans(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    line = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(line, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars")


@query(r"""
with sized as (
  select doc_id, source, md5(cast(doc_id as varchar)) as k,
         cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size from documents),
totals as (select source, cast(sum(size) as bigint) as total from sized group by source),
weighed as (select *, (row_number() over (order by source nulls last) - 1) % 3 + 1 as w from totals),
drifts(w, drift) as (values (1, 0.5::double), (2, 0.0::double), (3, -0.5::double)),
chained as (
  select *, (select sum(total) from totals)
            - coalesce(sum(3 * total) over (o rows between unbounded preceding and 1 preceding), 0) as open_tokens,
         sum(w) over (o rows between current row and unbounded following) as open_weight,
         row_number() over o as place
  from weighed window o as (order by total / w, source nulls last)),
level as (
  select coalesce(arg_min(cast(open_tokens as double) / cast(open_weight as double), place), 0) as l from chained
  where 3 * total >= w * (cast(open_tokens as double) / cast(open_weight as double))),
targets as (select source, total, least(cast(3 * total as double), w * l) as target, drift from weighed join drifts using (w), level),
placed as (
  select doc_id, size, total, target, 1.0::double - drift as start, 4.0::double * drift as bend,
         coalesce(sum(size) over (partition by sized.source order by k, doc_id
                                  rows between unbounded preceding and 1 preceding), 0) as before
  from sized join targets on sized.source is not distinct from targets.source),
shared as (
  select *, list_transform([0, 1, 2], lambda c: case when target > 0 then
    (cast(c * total + before as double) + cast(size as double) / 2.0::double) / target else 0.0::double end) as shares
  from placed),
counted as (
  select *, case when target > 0 then len(list_filter(shares, lambda s: s <= 1.0::double)) else 1 end as copies from shared)
select doc_id, size, total as source_size, target, cast(size * copies as bigint) as taken,
       case when copies > 0 then least(1.0::double, case when target > 0
         then 2.0::double * shares[1] / (start + sqrt(start * start + bend * shares[1])) else 0.0::double end) end as first_position
from counted
""")
def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


@query()
def op9_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    rules = secrets.BASE_RULES + secrets.MORE_RULES
    base = len(secrets.BASE_RULES)
    kinds = F.array(*[F.lit(r.kind) for r in rules])

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", F.get(kinds, s["number"]), s["start"].cast("string"), s["end"].cast("string"))), ",")

    found = secrets.scan(table(spark, folder, "documents"), rules)
    def count(n: int):
        return F.size(F.filter("spans", lambda s: s["number"] == n)).cast("long").alias(f"n_{rules[n].kind}")

    own = F.filter("spans", lambda s: s["number"] < base)
    return found.select("doc_id", *map(count, range(base)), F.sha2(listed(own), 256).alias("base_sha256"),
                        listed(F.col("spans")).alias("spans"))


@query()
def op6_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    coded = pieces.encode_decode(table(spark, folder, "documents"), model)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


@query()
def op10_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    found = licences.scan(table(spark, folder, "documents"))
    starts = F.transform("places", lambda p: p["start"])

    def joined(labels):
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    base = F.transform("places", lambda p: p["label"])
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.concat(base, F.transform("spans", lambda s: s["label"]))).alias("labels"),
        F.when(F.size("places") > 0, 1.0)
        .otherwise(F.least(F.lit(1.0), F.coalesce(F.array_max(F.transform("spans", lambda s: s["covered"])), F.lit(0.0))))
        .alias("score"))


@query()
def op3_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    scored = quality.classify(table(spark, folder, "documents"), quality_model(spark, folder), {"doc_id": "doc_id"})
    return scored.select("doc_id", (fold() == 0).alias("held_out"), "score",
                         (F.col("score") >= QUALITY_FROM).cast("int").alias("predicted"))


@query("""
with recursive v as (
  select vec_id, list_transform(embedding, lambda x: cast(x as double)) as e from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id
          and len(a.e) = len(b.e) where list_cosine_similarity(a.e, b.e) >= 0.9),
reach(a, b) as (select vec_id, vec_id from embeddings union select r.a, l.b from reach r join links l on r.b = l.a),
least_of as (select a, min(b) as component_id from reach group by a)
select vec_id, (select count(*) from links where links.a = vec_id) as n_links, component_id,
       vec_id = component_id as kept
from embeddings join least_of on vec_id = a
""")
def op4_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, folder, "embeddings"))


@query()
def op8_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = F.coalesce(fold() == 1, F.lit(False))
    model = lm.train(docs.filter(~held_out), order=LM_ORDER)
    scored = lm.score(docs, model, {"doc_id": "doc_id"})
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known",
                         F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


@query(r"""
with recursive worded as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
shingled as (
  select doc_id, unnest(case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
                        else list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) end) as s
  from worded),
sets as (select distinct doc_id, s from shingled),
sizes as (select doc_id, count(*) as n from sets group by doc_id),
both_have as (select a.doc_id as a, b.doc_id as b, count(*) as common
              from sets a join sets b on a.s = b.s and a.doc_id <> b.doc_id group by all),
links as (select a, b from both_have join sizes x on a = x.doc_id join sizes y on b = y.doc_id
          where 100 * common >= 85 * (x.n + y.n - common)),
reach(a, b) as (select doc_id, doc_id from documents union select r.a, l.b from reach r join links l on r.b = l.a),
least_of as (select a, min(b) as component_id from reach group by a)
select doc_id, cast(coalesce(n, 0) as bigint) as n_shingles, component_id,
       (select count(*) from links where links.a = doc_id) as n_links
from documents left join sizes using (doc_id) join least_of on doc_id = a
""")
def op2_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.jaccard_join(table(spark, folder, "documents"))


@query()
def op13_token_output(spark: SparkSession, folder: str) -> DataFrame:
    model = public_tokenizers.path("byte_bpe_50k.json")
    return binary.read_documents(*binary.write_tokens(table(spark, folder, "documents"), model))


@query(r"""
with recursive turns as (
  select conv_id, turn, left(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 32) as digest,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as words
  from conversations),
own as (select conv_id, list(digest order by turn nulls first, digest) as digests,
               list(words order by turn nulls first, digest) as words from turns group by conv_id),
crc as (  -- CRC-32 of the decimal id, bit by bit
  select conv_id, xor(list_reduce(list_prepend(cast(4294967295 as bigint), range(8 * length(cast(conv_id as varchar)))),
    lambda c, i: xor((case when i % 8 = 0 then xor(c, ascii(substr(cast(conv_id as varchar), i // 8 + 1, 1))) else c end) >> 1,
      case when (case when i % 8 = 0 then xor(c, ascii(substr(cast(conv_id as varchar), i // 8 + 1, 1))) else c end) % 2 = 1
           then 3988292384 else 0 end)), 4294967295) % 4 as h from own),
rebuilt as (
  select o.conv_id, list_concat(coalesce(b.digests[1:h], []), o.digests[h + 1:]) as digests,
         list_concat(coalesce(b.words[1:h], []), o.words[h + 1:]) as words
  from own o join crc using (conv_id) left join own b on b.conv_id = o.conv_id - o.conv_id % 20),
members as (
  select conv_id, d, array_to_string(digests[1:d], '') as key, case when d > 0 then words[d] else 0 end as words, len(digests) as size
  from (select *, unnest(range(0, len(digests) + 1)) as d from rebuilt)),
nodes as (
  select key, d, min(conv_id) as conv_id, count(*) as n_convs, any_value(words) as words,
         sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (where size = d), '')) as ends_sha256
  from members group by key, d),
kids as (select left(key, 32 * (d - 1)) as key, d - 1 as d, count(*) as n from nodes where d > 0 group by all),
known as (select n.*, coalesce(k.n, 0) as n_children from nodes n left join kids k on n.key = k.key and n.d = k.d),
below as (
  select left(key, 32 * up) as key, up as d, sum((n_convs - 1) * words) as saved, count(*) filter (where n_children = 0) as leaves
  from (select *, unnest(range(0, d + 1)) as up from known) group by all)
select x.conv_id, x.d as depth, p.conv_id as parent_conv_id, x.n_convs, x.n_children, b.leaves as n_leaves,
       cast(b.saved as bigint) as saved_tokens, x.ends_sha256
from known x join below b on x.key = b.key and x.d = b.d
left join known p on x.d > 0 and p.d = x.d - 1 and p.key = left(x.key, 32 * (x.d - 1))
""")
def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    given = trie.turn_sequences(table(spark, folder, "conversations"))
    head = F.coalesce((F.crc32(F.col("id").cast("string").cast("binary")) % 4).cast("int"), F.lit(0))
    return trie.prefix_trie(trie.share_heads(given, head, F.col("id") - F.col("id") % 20))


@query(r"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
worded as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
grams as (
  select lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) as g
  from worded, (values (1), (2), (3), (4), (5)) sizes(m)),
f as (select lang, m, g, count(*) as c from grams group by all),
totals as (select lang, sum(c) as n from f where m = 1 group by lang),
candidates as (select lang, m, g, c as a, string_split(g, ' ') as w from f where m > 1 and c >= 100),
cuts as (
  select lang, m, g, a, k, array_to_string(w[1:k], ' ') as first, array_to_string(w[k + 1:], ' ') as rest
  from (select *, unnest(range(1, m)) as k from candidates)),
valued as (
  select cuts.lang, cuts.g, a, k, x.c as l, y.c as r, n, (1000::hugeint * a::hugeint * n::hugeint) // (x.c::hugeint * y.c::hugeint) as score
  from cuts join f x on x.lang = cuts.lang and x.g = first join f y on y.lang = cuts.lang and y.g = rest
  join totals t on t.lang = cuts.lang),
lowest as (select * from valued qualify row_number() over (partition by lang, g order by score, k) = 1),
inner_parts as (
  select distinct lang, a, array_to_string(w[i:i + s - 1], ' ') as g
  from (select *, unnest(range(1, m - s + 2)) as i from (select *, unnest(range(2, m)) as s from candidates))),
held as (select distinct c.lang, c.g from candidates c join inner_parts p on c.lang = p.lang and c.g = p.g and 100 * p.a >= 100 * c.a),
ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, g) as rank
  from lowest anti join held using (lang, g))
select lang, rank, g as phrase, a, l, r, cast(n as bigint) as n, cast(score as bigint) as score from ranked where rank <= 2000
""")
def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))
