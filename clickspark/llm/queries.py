"""The operators as named queries over the sample tables, with their SQL."""

from __future__ import annotations

import dataclasses
import pathlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickspark.llm import (
    chat,
    decontamination,
    html_text,
    language_id,
    line_dedup,
    prefix_trie,
    quality_rules,
    sentencepiece_codec,
    simhash_dedup,
    token_files,
    toxicity,
    warc,
    whitening,
)
from clickspark.sources.shared import materialize, shared_path

Query = Callable[[SparkSession, str], DataFrame]

PIECES = "piece_bpe_32k.model"

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    return dict(_SQL)


def _query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs, removed="n_removed", exact_words=1)


@_query
def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", simhash_dedup.hex_digits().alias("fingerprint"), "component_id"
    )


@_query
def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    more = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    chats = chat.format_chats(turns.unionByName(more))
    read = chats.select(
        "conv_id",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.learnt_text(F.col("segments")).alias("learnt"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )
    line = F.lit("\n")
    told = F.transform("turns", lambda t: F.concat(t["role"], line, t["text"], line))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(told, ""), 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        "formatted_chars",
        "valid",
    )


_SQL["op3_chat_formatting"] = r"""
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -7, 0, 'user', '\### Assistant: </turn> ok'
    union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'
), numbered as (
    select *, row_number() over (partition by conv_id order by turn, role, text) as k,
        lag(role, 1, '') over (partition by conv_id order by turn, role, text) as before,
        row_number() over (partition by conv_id order by turn desc, role desc, text desc) as back,
        length(text) + len(regexp_extract_all(text, '[\\#<:]')) as chars,
        case when role in ('system', 'user', 'assistant') then length(role)
            else 1 + length(role) + len(regexp_extract_all(role, '[\\#<:]')) end as label_chars
    from turns
)
select conv_id, count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by k)) as turns_sha256,
    cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
    sha256(coalesce(string_agg(text, '' order by k) filter (role = 'assistant'), '')) as loss_sha256,
    cast(sum(4 + label_chars + 2 + chars + 8) as bigint) as formatted_chars,
    bool_and((before, role) in (('', 'system'), ('', 'user'), ('system', 'user'),
        ('user', 'assistant'), ('assistant', 'user'))
        and (back > 1 or role = 'assistant')) as valid
from numbered group by conv_id
"""


@_query
def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = sentencepiece_codec.load(public_tokenizers.path(PIECES))
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    back = sentencepiece_codec.round_trip(docs, pieces)
    return back.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.xxhash64("ids").alias("ids_hash"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.col("decoded").eqNullSafe(F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


@_query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contained(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )


_SQL["op5_decontamination"] = r"""
with texts as (
    select 'd' as side, row_number() over () as r, doc_id as id, text from documents
    union all select 'i', row_number() over (), item_id, text from benchmark
), words as (
    select side, r, id, list_filter(string_split_regex(lower(coalesce(text, '')),
        '[\x09-\x0D\x20-/:-@\[-`{-~]+'), lambda x: x <> '') as w from texts
), shingles as (
    select distinct side, r, id, array_to_string(w[k:k + 4], ' ') as s
    from (select side, r, id, w, unnest(range(1, len(w) - 3)) as k from words where len(w) > 4)
), items as (
    select r, id as item_id, s, count(*) over (partition by r) as shingles
    from shingles where side = 'i'
)
select d.id as doc_id, item_id, shingles, count(*) as shared, count(*) / shingles as containment
from items i join shingles d on d.side = 'd' and d.s = i.s
group by d.r, d.id, i.r, item_id, shingles
having count(*) >= ceil(0.8 * shingles - 1e-9)
"""


@_query
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "warc")
    warc.write_warc(warc.page_records(_table(spark, sf_dir, "pages")), path)
    full = warc.read_warc(spark, path).where("record_type = 'response'")
    bare = warc.read_warc(spark, path, payload="false").where("record_type = 'revisit'")
    return (
        full.withColumns({
            "payload_length": F.octet_length("payload").cast("long"),
            "payload_digest": F.sha1("payload"),
        })
        .unionByName(bare)
        .select(
            warc.page_of(F.col("record_id")).alias("page_id"),
            F.col("payload_length").alias("payload_bytes"),
            "payload_digest",
            "record_type",
            warc.page_of(F.col("refers_to")).alias("refers_to"),
        )
    )


_SQL["op6_warc"] = r"""
with payloads as (
    select page_id, coalesce(html, '') as payload,
        octet_length(encode(coalesce(html, ''))) as payload_bytes from pages
), led as (
    select *, max(page_id) over (partition by payload) as leader from payloads
)
select page_id, payload_bytes, sha1(payload) as payload_digest,
    case when payload_bytes < 1000 or page_id = leader then 'response' else 'revisit' end as record_type,
    case when payload_bytes >= 1000 and page_id <> leader then leader end as refers_to
from led
"""


@_query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.fit(docs.where(~language_id.held_out()))
    found = language_id.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


@_query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").where(~toxicity.held_out())
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


@_query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return quality_rules.judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


_SQL["op9_quality_rules"] = r"""
with texts as (
    select row_number() over () as r, doc_id, source, coalesce(text, '') as text from documents
), words as (
    select *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') as w,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l
    from texts
), windows as (
    select r, w[k] as a, w[k + 1] as b, w[k + 2] as c, k
    from (select r, w, unnest(range(1, len(w) - 1)) as k from words where len(w) > 2)
), repeated as (
    select r, count(distinct place) as n_repeat_words from (
        select r, unnest([k, k + 1, k + 2]) as place from (
            select r, k, count(*) over (partition by r, a, b, c) as n from windows
        ) where n > 1
    ) group by r
), metrics as (
    select doc_id, source, len(w) as n_words,
        cast(length(array_to_string(w, '')) as bigint) as word_chars,
        cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
        len(l) as n_lines, len(l) - len(list_distinct(l)) as n_dup_lines,
        coalesce(n_repeat_words, 0) as n_repeat_words
    from words left join repeated using (r)
), judged as (
    select *, [n_words < 50, 100 * n_repeat_words > 50 * n_words,
        10 * n_symbols > word_chars, 2 * n_dup_lines > n_lines] as fails from metrics
), hosts as (
    select source, k, count(*) as n, sum(cast(fails[k] as int)) / count(*) as share
    from (select source, fails, unnest([1, 2, 3, 4]) as k from judged where source is not null)
    group by source, k
), priors as (
    select k, avg(share) as mean, var_pop(share) as spread, avg(1.0 / n) as per_doc
    from hosts group by k
), rejected as (
    select distinct source from hosts join priors using (k),
        lateral (select spread - mean * (1 - mean) * per_doc as beyond) t,
        lateral (select greatest(mean * (1 - mean) / nullif(beyond, 0) - 1, 0) as weight) u
    where case when beyond > 0 then (share * n + weight * mean) / (n + weight) else mean end > 0.5
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    fails[1] or fails[2] as base_failed,
    not (fails[1] or fails[2]) and (source is null or source not in (from rejected)) as kept
from judged
"""


@_query
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = pathlib.Path(public_tokenizers.path("word_bpe_49k.json")).read_text()
    files = token_files.write_tokens(
        _table(spark, sf_dir, "documents"), shared_path(spark, "ids"), tokenizer, 49_408, end=1
    )
    return token_files.read_tokens(spark, files).select(
        "doc_id",
        "start",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


@_query
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = whitening.usable(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    whole = F.transform("embedding", lambda c: F.floor(1024 * c.cast("double")) + 100_000)
    vectors = vectors.select("vec_id", whole.alias("x"))
    m = whitening.moments(vectors, "x")
    vectors = vectors.withColumn("deviation", whitening.deviation("x", m))
    found = whitening.whiten(vectors, m, "x", components=8)
    found = dataclasses.replace(found, rows=materialize(found.rows, "whitened"))
    explained = F.array(*(F.lit(float(e) / found.trace) for e in found.values)).cast("array<double>")
    error = whitening.identity_error(found)
    each = found.rows.select(
        "vec_id", "deviation", F.posexplode(F.arrays_zip("whitened", explained.alias("explained")))
    )
    return each.select(
        "vec_id",
        (F.col("pos") + 1).cast("int").alias("component"),
        F.lit(m.n).cast("long").alias("n"),
        "deviation",
        "col.whitened",
        "col.explained",
        F.lit(error).alias("identity_error"),
    )


@_query
def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract(pages).withColumn("n_chars", F.length("text").cast("long"))


#: The outline of the sample pages, where the article is an element and no tag is in quotes.
_SQL["op12_html_extraction"] = r"""
with articles as (
    select page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*?)(</article>|$)', 1, 's') as article
    from pages
), parts as (
    select page_id, url, list_transform(string_split_regex(article, '</?(p|h1)>'), lambda x:
        trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
            regexp_replace(replace(x, '<br>', ' '), '<[^>]*>', '', 'g'),
            '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&quot;?', '"', 'g'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))) as part
    from articles
), texts as (
    select page_id, url, array_to_string(list_filter(part, lambda x: x <> ''), chr(10) || chr(10)) as text from parts
)
select page_id, url, text, length(text) as n_chars from texts
"""


@_query
def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = materialize(prefix_trie.conversations(_table(spark, sf_dir, "conversations")), "own")
    c = F.col("conv_id")
    begun = own.where(c % 20 == 0).select(c.alias("from"), F.slice("turns", 1, 3).alias("opening"))
    rebuilt = own.withColumns({
        "from": c - c % 20,
        "h": F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(4)).cast("int"),
    }).join(begun, "from", "left")
    none = F.slice("turns", 1, 0)
    opening = F.slice(F.coalesce("opening", none), F.lit(1), F.col("h"))
    rest = F.slice("turns", F.col("h") + 1, F.size("turns"))
    return prefix_trie.trie(rebuilt.select("conv_id", F.concat(opening, rest).alias("turns")))


_SQL["op13_conversation_trie"] = r"""
with bits as (
    select k, list_reduce([cast(k as bigint)] || range(8), lambda c, i:
        xor(c >> 1, (c & 1) * 3988292384)) as word from range(256) t(k)
), crc as (
    select list(word order by k) as of from bits
), own as (
    select conv_id as c, role, text, row_number() over (partition by conv_id order by turn nulls first, sha) as k
    from (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text,
        sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as sha
        from conversations where conv_id is not null)
), ids as (
    select c, c - c % 20 as base, (xor(list_reduce([4294967295] || list_transform(
        split(cast(c as varchar), ''), lambda x: cast(ascii(x) as bigint)),
        lambda h, b: xor(h >> 8, crc.of[1 + xor(h & 255, b)])), 4294967295)) % 4 as h
    from (select distinct c from own), crc
), turns as (
    select ids.c, 0 as late, own.k, role, text from ids join own on own.c = base and own.k <= h
    union all select ids.c, 1, own.k, role, text from ids join own on own.c = ids.c and own.k > h
), numbered as (
    select c, role, text, row_number() over (partition by c order by late, k) as d from turns
), prefixes as (
    select c, d, list(sha256(length(role) || ':' || role || text)) over (partition by c order by d) as path,
        len(list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '')) as words
    from numbered
    union all select c, 0, [], 0 from ids
), lengths as (
    select c, max(d) as n from prefixes group by c
), nodes as (
    select path, d, min(prefixes.c) as conv_id, count(*) as n_convs, (count(*) - 1) * any_value(words) as saved,
        sha256(coalesce(string_agg(cast(prefixes.c as varchar), ',' order by prefixes.c) filter (d = n), '')) as ends_sha256
    from prefixes join lengths on lengths.c = prefixes.c group by path, d
), kids as (
    select path[:len(path) - 1] as path, count(*) as n from nodes where d > 0 group by 1
), sums as (
    select path[:up] as path, sum(saved) as saved, sum(leaf) as leaves
    from (select nodes.path, nodes.saved, cast(kids.n is null as int) as leaf, unnest(range(nodes.d + 1)) as up
        from nodes left join kids on kids.path = nodes.path)
    group by 1
)
select nodes.conv_id, nodes.d as depth, above.conv_id as parent_conv_id, nodes.n_convs,
    coalesce(kids.n, 0) as n_children, cast(sums.leaves as bigint) as n_leaves,
    cast(sums.saved as bigint) as saved_tokens, nodes.ends_sha256
from nodes join sums on sums.path = nodes.path
left join kids on kids.path = nodes.path
left join nodes above on nodes.d > 0 and above.path = nodes.path[:nodes.d - 1]
"""
