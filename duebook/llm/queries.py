"""The operators as queries over the sample tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duebook.llm import bpe, dialogue, html, language, licenses, manifest, neighbours, packing, pieces, quality, sharding, simhash, warc
from duebook.llm.common import prepare, shared_folder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


@query
def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents encoded and decoded, as digests."""
    path = public_tokenizers.path("word_bpe_49k.json")
    done = bpe.encode_texts(table(spark, folder, "documents"), path, decode=True)
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    """The stored ledger of every document, the standard policy's verdict, and what the policy would keep without a rule.

    The texts are read once, for the ledger. Verdict and ablation are arithmetic on its bits.
    """
    path = f"{shared_folder(spark)}/quality-ledger-{uuid.uuid4().hex}"
    quality.save_ledger(quality.with_ledger(table(spark, folder, "documents").select("doc_id", "text")), path)
    ledger = quality.load_ledger(spark, path)
    without = quality.ablations(ledger).select(F.col("rule").alias("only_rule"), "n_kept_without")
    judged = ledger.select(
        "doc_id",
        *[F.col("measured")[m].alias(m) for m in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        (~quality.kept(quality.BASE)).alias("base_failed"),
        (quality.kept(quality.BASE) & quality.kept()).alias("kept"),
        "failed",
        quality.only_rule().alias("only_rule"),
    )
    # One row per rule.
    return judged.join(F.broadcast(without), "only_rule", "left").select(*judged.columns, "n_kept_without")


#: Characters of white space and of words in the rules' sense, as SQL.
_WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"
ORACLE["op9_quality"] = rf"""
with docs as (
    select row_number() over () as r, doc_id, coalesce(text, '') as text, {_WORDS} as w from documents
), flags as (
    select r, i, w[i] = w[i - 1] as again,
        case when i + 7 <= len(w) then array_to_string(w[i : i + 7], ' ') end as shingle
    from docs, lateral (select unnest(generate_series(1, len(w))) as i)
), often as (
    select *, count(*) over (partition by r, shingle) > 1 and shingle is not null as rep from flags
), covered as (
    select r, again, max(rep::int) over (partition by r order by i rows between 7 preceding and current row) as hit from often
), words as (
    select r, sum(hit) as n_repeat_words, count(*) filter (where again) as n_stutters from covered group by r
), lines as (
    select r, l, count(*) as n from (select r, unnest(string_split(text, chr(10))) as l from docs)
    where regexp_matches(l, '[^\x20\x09-\x0D]') group by r, l
), line_sums as (
    select r, sum(n) as n_lines, sum(n - 1) as n_dup_lines from lines group by r
), sizes as (
    select r, doc_id, len(w) as n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) as word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols,
        length(regexp_replace(text, '[^A-Z]', '', 'g')) as n_upper,
        length(regexp_replace(text, '[\x00-\x40\x5B-\x60\x7B-\x7F]', '', 'g')) as n_letters
    from docs
), measured as (
    select sizes.*, coalesce(n_repeat_words, 0) as n_repeat_words, coalesce(n_stutters, 0) as n_stutters,
        coalesce(n_lines, 0) as n_lines, coalesce(n_dup_lines, 0) as n_dup_lines
    from sizes left join words using (r) left join line_sums using (r)
), bits as (
    select *, (n_words < 20)::bigint + 2 * (100 * n_repeat_words > 30 * n_words)::bigint
        + 4 * (10 * n_symbols > 3 * n_words)::bigint + 8 * (2 * n_dup_lines > n_lines)::bigint
        + 16 * (word_chars < 2 * n_words)::bigint + 32 * (word_chars > 20 * n_words)::bigint
        + 64 * (2 * n_upper > n_letters)::bigint + 128 * (2 * n_letters < word_chars)::bigint
        + 256 * (2 * n_stutters > n_words)::bigint as failed
    from measured
)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
    n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words, failed & 3 <> 0 as base_failed,
    failed = 0 as kept, failed,
    case failed when 1 then 'few_words' when 2 then 'repeated_words' when 4 then 'many_symbols' when 8 then 'repeated_lines'
        when 16 then 'short_words' when 32 then 'long_words' when 64 then 'shouting' when 128 then 'few_letters' when 256 then 'stutters'
        end as only_rule,
    case when bit_count(failed) = 1 then (count(*) filter (where failed = 0) over ()) + count(*) over (partition by failed) end as n_kept_without
from bits
"""


@query
def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    packed = packing.pack(packing.token_pieces(table(spark, folder, "documents"), path))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op8_language(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = language.fit(documents.filter(~language.held_out(F.col("doc_id"))))
    guessed = language.with_language(documents.select("doc_id", "text"), model)
    return guessed.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op2_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """Licence phrases, notices and tags of every document."""
    found = licenses.with_licenses(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        *[F.col(c).cast("long") for c in ("n_words", "n_base", "first_word", "last_word")],
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


@query
def op5_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents dealt to 40 shards of near equal bytes, by way of fixed virtual slots and a stored map of them.

    Version 1 is dealt, stored and read again, then edited where shards are out of balance; rows go by the newest version.
    """
    documents = table(spark, folder, "documents").select("doc_id", "text")
    sized = sharding.with_size(documents)
    maps = f"{shared_folder(spark)}/shard-maps-{uuid.uuid4().hex}"
    sharding.save_map(spark, sharding.new_map(sharding.slot_loads(sized), 40), maps)
    sharding.save_map(spark, sharding.rebalanced(sharding.load_map(spark, maps)), maps)
    placed = sharding.placed(sized, sharding.load_map(spark, maps))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("place").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        "version",
    )


@query
def op7_html(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return html.extract(table(spark, folder, "pages")).select("page_id", "url", "text", "n_chars")


@query
def op6_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest of every twentieth vector."""
    found = neighbours.nearest(table(spark, folder, "embeddings"), lambda id: id % 20 == 0, k=20)
    return found.select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def archive_records(pages: DataFrame) -> DataFrame:
    """A crawl of the pages: a response for each, and a later or earlier revisit by another spelling of its url."""
    page, tag = F.col("page_id"), F.substring(F.md5(F.coalesce(F.col("html"), F.lit("")).cast("binary")), 1, 12)
    at = 1_700_000_000 + page * 600
    quoted = lambda x: F.concat(F.lit('"'), x, F.lit('"'))
    size = F.coalesce(F.octet_length("html"), F.lit(0)).cast("string")
    full = F.create_map(
        *[F.lit("ETag"), quoted(tag), F.lit("Content-Length"), size, F.lit("Content-Type"), F.lit("text/html"), F.lit("Date"), at.cast("string")]
    )
    spelled = F.when(page % 4 == 1, F.regexp_replace("url", "^http://", "https://")).when(page % 4 == 2, F.concat("url", F.lit("#top"))).otherwise(F.col("url"))
    later = at + (page % 5 - 1) * 1800
    short = F.map_concat(
        F.create_map(F.lit("date"), later.cast("string"), F.lit("content-length"), F.lit("0"), F.lit("cache-control"), F.lit("max-age=60")),
        F.when(page % 7 < 5, F.create_map(F.lit("etag"), F.concat(F.lit("W/"), quoted(tag))))
        .when(page % 7 == 5, F.create_map(F.lit("etag"), F.lit('"other"')))
        .otherwise(F.create_map().cast("map<string,string>")),
    )
    first = pages.select((2 * page).alias("record_id"), "url", at.alias("captured"), F.lit(False).alias("is_revisit"), full.alias("headers"))
    again = pages.select((2 * page + 1).alias("record_id"), spelled.alias("url"), later.alias("captured"), F.lit(True).alias("is_revisit"), short.alias("headers"))
    return first.union(again)


@query
def op10_revisits(spark: SparkSession, folder: str) -> DataFrame:
    """Every revisit of a crawl of the pages with the response it stands for and its headers."""
    resolved = warc.resolve(archive_records(table(spark, folder, "pages")))
    lines = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return resolved.select("record_id", "canonical_url", "captured", "resolved_id", "outcome", F.array_join(lines, "\n").alias("header_lines"))


ORACLE["op10_revisits"] = r"""
with crawl as (
    select page_id, url, substr(md5(coalesce(html, '')), 1, 12) as tag, coalesce(strlen(html), 0)::varchar as size,
        1700000000 + page_id * 600 as moment, 1700000000 + page_id * 600 + (page_id % 5 - 1) * 1800 as later from pages
), headers as (
    select 2 * page_id as record_id, unnest(['etag', 'content-length', 'content-type', 'date']) as name,
        unnest(['"' || tag || '"', size, 'text/html', moment::varchar]) as value from crawl
    union all
    select 2 * page_id + 1, unnest(['date', 'content-length', 'cache-control']), unnest([later::varchar, '0', 'max-age=60']) from crawl
    union all
    select 2 * page_id + 1, 'etag', case when page_id % 7 < 5 then 'W/"' || tag || '"' else '"other"' end from crawl where page_id % 7 < 6
), records as (
    select 2 * page_id as record_id, url, moment as captured, 1 as is_response from crawl
    union all
    select 2 * page_id + 1, case when page_id % 4 = 1 and starts_with(url, 'http://') then 'https://' || substr(url, 8)
        when page_id % 4 = 2 then url || '#top' else url end, later, 0 from crawl
), bare as (
    select *, split_part(url, '#', 1) as u from records
), parts as (
    select *, regexp_replace(lower(regexp_extract(u, '^[a-zA-Z]+://([^/?:]*)', 1)), '^www[0-9]*[.]', '') as host,
        regexp_extract(u, '^[a-zA-Z]+://[^/?]*([^?]*)', 1) as path, regexp_extract(u, '[?](.*)$', 1) as asked from bare
), kept as (
    select record_id, string_agg(p, '&' order by p) as q from (select record_id, unnest(string_split(asked, '&')) as p from parts)
    where p <> '' and not regexp_matches(lower(p), '^(utm_[a-z]+|ref|fbclid|gclid|sessionid)(=|$)') group by record_id
), named as (
    select parts.record_id, captured, is_response,
        host || case when rtrim(path, '/') = '' then '/' else rtrim(path, '/') end || coalesce('?' || q, '') as canonical_url
    from parts left join kept using (record_id)
), looked as (
    select *, last_value(case when is_response = 1 then record_id end ignore nulls) over (
        partition by canonical_url order by captured, is_response, record_id rows between unbounded preceding and current row) as found
    from named
), judged as (
    select l.record_id, canonical_url, captured, found,
        case when found is null then 'no response' when a.value is null or b.value is null then 'unchecked'
            when ltrim(a.value, 'W/') = ltrim(b.value, 'W/') then 'matched' else 'validators differ' end as outcome
    from looked l left join headers a on a.record_id = l.record_id and a.name = 'etag'
        left join headers b on b.record_id = found and b.name = 'etag' where is_response = 0
), settled as (
    select record_id, found from judged where outcome in ('matched', 'unchecked')
), permitted as (
    select s.record_id, name, value from settled s join headers h using (record_id) where name not in ('content-length', 'content-type')
), merged as (
    select * from permitted
    union all
    select s.record_id, h.name, h.value from settled s join headers h on h.record_id = s.found
    where not exists (select 1 from permitted p where p.record_id = s.record_id and p.name = h.name)
), lines as (
    select record_id, string_agg(name || ': ' || value, chr(10) order by name) as header_lines from merged group by record_id
)
select record_id, canonical_url, captured, s.found as resolved_id, outcome, header_lines
from judged left join settled s using (record_id) left join lines using (record_id)
"""


@query
def op12_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents encoded and decoded, as digests."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    done = pieces.encode_texts(table(spark, folder, "documents"), path, decode=True)
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@query
def op13_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Leaf, proof and roots of every document, and what a tampered document's proof comes to."""
    documents = table(spark, folder, "documents")
    picked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    text = F.when(picked, F.translate("text", UPPER, LOWER))
    made = manifest.manifest(documents, other={"text": text})
    folded = manifest.folded(F.coalesce("other", "leaf"), F.col("above"))
    return made.select(
        F.col("id").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        manifest.proof(F.col("above")).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def _crc32(value: str) -> str:
    """Unsigned CRC-32 of an ASCII string in DuckDB SQL: each byte, then eight shifts."""
    steps = f"flatten(list_transform(string_split({value}, ''), lambda ch: [ascii(ch)::bigint, 0, 0, 0, 0, 0, 0, 0]))"
    step = "lambda c, b: xor(xor(c, b) >> 1, case when xor(c, b) & 1 = 1 then 3988292384 else 0 end)"
    return f"xor(list_reduce({steps}, {step}, 4294967295::bigint), 4294967295)"


def _field(name: str) -> str:
    return f"coalesce(strlen({name}::varchar) || ':' || {name}::varchar, '-')"


ORACLE["op13_manifest"] = f"""
with recursive docs as (
    select row_number() over () as r, coalesce(':' || source, '-') as tree, doc_id,
        {_field("doc_id")} || {_field("source")} || {_field("lang")} || {_field("n_chars")} as head, text,
        doc_id is not null and {_crc32("coalesce(doc_id, 0)::varchar")} % 5 = 0 as picked
    from documents
), leaves as (
    select r, tree, doc_id, sha256(head || {_field("text")}) as leaf,
        case when picked then sha256(head || {_field(f"translate(text, '{UPPER}', '{LOWER}')")}) end as other
    from docs
), placed as (
    select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as pos, count(*) over (partition by tree) as total from leaves
), nodes as (
    select 0 as lvl, tree, pos, total, leaf as digest from placed
    union all
    select lvl + 1, tree, pos // 16, (any_value(total) + 15) // 16, sha256(string_agg(digest, '' order by pos)) from nodes
    where total > 1 group by lvl, tree, pos // 16
), subroots as (
    select tree, digest, row_number() over (order by encode(tree)) - 1 as pos, count(*) over () as total from nodes where total = 1
), tops as (
    select 0 as lvl, pos, total, digest from subroots
    union all
    select lvl + 1, pos // 16, (any_value(total) + 15) // 16, sha256(string_agg(digest, '' order by pos)) from tops where total > 1 group by lvl, pos // 16
), sides as (
    select tree, lvl, pos, coalesce(string_agg(digest, '') over (w rows between unbounded preceding and 1 preceding), '') as lhs,
        coalesce(string_agg(digest, '') over (w rows between 1 following and unbounded following), '') as rhs
    from nodes window w as (partition by tree, lvl, pos // 16 order by pos)
), top_sides as (
    select lvl, pos, coalesce(string_agg(digest, '') over (w rows between unbounded preceding and 1 preceding), '') as lhs,
        coalesce(string_agg(digest, '') over (w rows between 1 following and unbounded following), '') as rhs
    from tops window w as (partition by lvl, pos // 16 order by pos)
), walks as (
    select r, tree, 0 as lvl, pos, total, '' as proof, coalesce(other, leaf) as node from placed
    union all
    select r, tree, lvl + 1, pos // 16, (total + 15) // 16, proof || lhs || rhs, sha256(lhs || node || rhs)
    from walks join sides using (tree, lvl, pos) where total > 1
), climbs as (
    select r, 0 as lvl, s.pos, s.total, proof, node from walks w join subroots s using (tree) where w.total = 1
    union all
    select r, lvl + 1, pos // 16, (total + 15) // 16, proof || lhs || rhs, sha256(lhs || node || rhs)
    from climbs join top_sides using (lvl, pos) where total > 1
)
select doc_id, leaf, s.digest as subroot, t.digest as root, sha256(proof) as proof_sha256, node as folded_root, node = t.digest as verified
from placed p join climbs w on w.r = p.r and w.total = 1 join subroots s on s.tree = p.tree join tops t on t.total = 1
"""


@query
def op11_dialogue(spark: SparkSession, folder: str) -> DataFrame:
    """Faults, cheapest audit and repaired text of every conversation after damage."""
    conversations = table(spark, folder, "conversations")
    damaged = dialogue.damaged(conversations)
    found, gaps = dialogue.summaries(dialogue.repair(damaged)), dialogue.gaps(damaged)
    ids = conversations.select(F.col("conv_id").alias("conv")).distinct()
    met = ids.join(found, ids["conv"].eqNullSafe(found["id"]), "left").drop("id")
    met = met.join(gaps, met["conv"].eqNullSafe(gaps["id"]), "left")
    return met.select(
        F.col("conv").alias("conv_id"),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def _dialogue_sql() -> str:
    """The cheapest audits row by row, as a list of (cost, audit, repaired text) for each state."""

    def edited(held: str, cost: str, letter: str, line: str | None) -> str:
        text = f"{held}.t" if line is None else f"{held}.t || case when {held}.t = '' then '' else chr(10) end || {line}"
        return f"case when {held} is not null then {{'c': {held}.c + {cost}, 'a': {held}.a || '{letter}', 't': {text}}} end"

    def best(*options: str) -> str:
        return f"list_sort(list_filter([{', '.join(options)}], lambda x: x is not null))[1]"

    added = {"u": "'user:'", "a": "'assistant:'"}
    one = lambda held, who: edited(held, "2", "I", added[who])
    two = lambda held: (
        f"case when {held} is not null then {{'c': {held}.c + 4, 'a': {held}.a || 'II', "
        f"'t': {held}.t || case when {held}.t = '' then '' else chr(10) end || 'user:' || chr(10) || 'assistant:'}} end"
    )
    gone = lambda held: edited(held, "3", "D", None)
    told = lambda held, who: f"case when not must then {edited(held, '2 + late', 'R', added[who] + ' || text')} end"
    kept = lambda held, who: f"case when not must and initial = '{who}' then {edited(held, 'late', 'K', "role || ':' || text")} end"
    before_user = ("e[1]", "e[2]", "e[4]")
    reached = f"[st[1], st[2], {best('st[3]', one('st[1]', 'u'), one('st[2]', 'u'), one('st[4]', 'u'))}, {best('st[4]', one('st[3]', 'a'), two('st[1]'), two('st[2]'))}]"
    after = ", ".join(
        [
            best(gone("e[1]")),
            best(gone("e[2]"), kept("e[1]", "s")),
            best(gone("e[3]"), *[kept(x, "u") for x in before_user], *[told(x, "u") for x in before_user]),
            best(gone("e[4]"), kept("e[3]", "a"), told("e[3]", "a")),
        ]
    )
    return rf"""
with recursive filled as (
    select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
        {_crc32("coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')")} % 20 as kind from conversations
), damaged as (
    select conv_id, turn, case when kind = 4 then 'user' else role end as role,
        case when kind = 1 then '' when kind = 2 then translate(text, '.!?', '') else text end as text,
        unnest(range(case when kind = 3 then 2 else 1 end)) as time
    from filled where kind <> 0
), ordered as (
    select conv_id, turn, role, text, substr(role, 1, 1) as initial,
        row_number() over (partition by conv_id order by turn nulls first, role, sha256(strlen(role) || ':' || role || text)) as i
    from damaged
), judged as (
    select *, not regexp_matches(text, '[^\x20\x09-\x0D]') as blank,
        row_number() over (partition by conv_id, role, text order by i) > 1 as again,
        not regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') as open_end,
        coalesce(lag(initial) over (partition by conv_id order by i) || initial not in ('su', 'ua', 'au'), false) as odd
    from ordered
), rows as (
    select *, blank or again as must, (open_end and not blank and not again)::int as late from judged
), counts as (
    select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (where blank) as blank,
        count(*) filter (where again and not blank) as duplicate, sum(late) as truncated, count(*) filter (where odd) as illegal, max(i) as n
    from rows group by conv_id
), walk as (
    select conv_id, 0::bigint as i, [{{'c': 0::bigint, 'a': ''::varchar, 't': ''::varchar}}, null, null, null] as st from counts
    union all
    select conv_id, i, [{after}] from (
        select r.conv_id, r.i, r.role, r.text, r.initial, r.must, r.late, {reached} as e
        from walk w join rows r on r.conv_id is not distinct from w.conv_id and r.i = w.i + 1
    )
), ended as (
    select w.conv_id, {best("st[1]", "st[4]", one("st[3]", "a"), two("st[2]"))} as f
    from walk w join counts c on c.conv_id is not distinct from w.conv_id and c.n = w.i
)
select o.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate,
    coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal, coalesce(f.c, 0)::bigint as cost,
    coalesce(f.a, '') as audit, sha256(coalesce(f.t, '')) as repaired_sha256
from (select distinct conv_id from conversations) o left join counts c on c.conv_id is not distinct from o.conv_id
    left join ended e on e.conv_id is not distinct from o.conv_id
"""


ORACLE["op11_dialogue"] = _dialogue_sql()
