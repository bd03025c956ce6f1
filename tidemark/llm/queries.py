"""One query per operator over its whole table, and the checking SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe,
    exact_dedup,
    html_extract,
    license_scan,
    line_dedup,
    merkle,
    ngram_join,
    prefix_trie,
    quality_classifier,
    quality_rules,
    source_mix,
    suffix_dedup,
    token_counts,
)
from tidemark.llm.common import small_batches, stored
from tidemark.session import apply_defaults

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Tokenizer of the counting and encoding queries.
TOKENIZER = "byte_bpe_50k.json"


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(small_batches(apply_defaults(spark)), sf_dir)
        if oracle:
            ORACLES[name] = oracle
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_html_extract")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.html_extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


@query("op2_token_counts")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


@query(
    "op3_line_dedup",
    """
with d as (
    select distinct doc_id, text, string_split(text, chr(10)) as lines from documents
), w as (
    select doc_id, lines[k : k + 2] as win, k
    from (select doc_id, lines, unnest(range(1, len(lines) - 1)) as k from d)
), r as (
    select doc_id, k, row_number() over (partition by win order by doc_id, k) as nth
    from w where regexp_matches(array_to_string(win, ' '), '[^\x20\x09-\x0D]')
), c as (
    select distinct doc_id, unnest([k, k + 1, k + 2]) as k from r where nth > 1
), x as (
    select doc_id, list(k) as gone from c group by doc_id
)
select doc_id, coalesce(len(lines), 0)::bigint as n_lines, coalesce(len(gone), 0)::bigint as n_removed,
       case when gone is null then text
            else array_to_string(list_filter(lines, lambda l, i: not list_contains(gone, i)), chr(10)) end as text
from d left join x using (doc_id)
""",
)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", "text")


@query(
    "op4_exact_dedup",
    """
with t as (
    select doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') as t from documents
), g as (
    select t, min(doc_id) as keep_id, count(*) as group_size from t group by t
)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(t) as text_sha256
from t join g using (t)
""",
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(
        table(spark, sf_dir, "documents"), carry={"text_sha256": bpe.digest(F.col("content"))}
    )


@query(
    "op5_quality_rules",
    f"""
with w as (
    select doc_id, source, coalesce(text, '') as text,
           regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as words,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines
    from documents
), g as (
    select doc_id, k, words[k : k + 4] as gram
    from (select doc_id, words, unnest(range(1, len(words) - 3)) as k from w)
), r as (
    select doc_id, k from g qualify count(*) over (partition by doc_id, gram) > 1
), c as (
    select doc_id, count(distinct p) as n_repeat_words
    from (select doc_id, unnest(range(k, k + 5)) as p from r) group by doc_id
), m as (
    select w.doc_id, source, len(words)::bigint as n_words,
           coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::bigint as word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
           len(lines)::bigint as n_lines,
           (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
           coalesce(n_repeat_words, 0)::bigint as n_repeat_words
    from w left join c using (doc_id)
), f as (
    select *, n_words < 10 as short, 100 * n_repeat_words > 20 * n_words as repeats,
           10 * n_symbols > n_words as symbols, 10 * n_dup_lines > 3 * n_lines as dup_lines
    from m
), l as (
    select source, rule, count(*)::double as n, sum(failed::int)::double as bad
    from (unpivot (select source, short, repeats, symbols, dup_lines from f)
          on short, repeats, symbols, dup_lines into name rule value failed)
    group by source, rule
), p as (
    select rule, sum(bad) / sum(n) as mean, sum(bad * bad / n) / sum(n) as square, sum(n) as docs, count(*) as hosts
    from l group by rule
), s as (
    select rule, mean, mean * (1 - mean) as chance,
           square - mean * mean - mean * (1 - mean) * hosts / docs as spread from p
), b as (
    select rule, mean, least(greatest(case when spread <= 0 then 1000 else chance / spread - 1 end, 1), 1000) as strength
    from s
), v as (
    select source, max(case when mean in (0, 1) then (bad + mean) / (n + 1)
                            else (bad + mean * strength) / (n + strength) end) as host_rate
    from l join b using (rule) group by source
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       short or repeats as base_failed,
       not (short or repeats) and host_rate <= {quality_rules.HOST_LIMIT} as kept
from f join v on f.source is not distinct from v.source
""",
)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query("op6_quality_classifier")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _license_sql() -> str:
    """Exact containment in every window, for the built-in templates."""
    rows = ", ".join(
        f"('{name}', '{text.replace(chr(39), chr(39) * 2)}', {license_scan.template_class(len(license_scan.Scanner({name: text}).sets[0]))})"
        for name, text in license_scan.built_in().items()
    )
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
with t as (
    select license, regexp_extract_all({lower.format("t")}, '[a-z0-9]+') as words, j
    from (values {rows}) as v(license, t, j)
), s as (
    select distinct license, j, words[k : k + 4] as gram
    from (select *, unnest(range(1, len(words) - 3)) as k from t)
), n as (
    select license, count(*) as shingles from s group by license
), d as (
    select doc_id, regexp_extract_all({lower.format("text")}, '[a-z0-9]+') as words from documents
), g as (
    select doc_id, k, words[k + 1 : k + 5] as gram, len(words) - 4 as total
    from (select *, unnest(range(0, len(words) - 4)) as k from d)
), h as (
    select doc_id, license, j, k, gram, total from g join s using (gram)
), w as (
    select doc_id, license, j, total, gram, k // (1 << j) as win from h
    union all
    select doc_id, license, j, total, gram, k // (1 << j) - 1 from h
), f as (
    select doc_id, license, win * (1 << j) as start, count(distinct gram)::double / max(shingles) as share
    from w join n using (license)
    -- the last window starts one step before the last step, if there are two
    where win >= 0 and win <= greatest((total - 1) // (1 << j) - 1, 0)
    group by doc_id, license, win, j
)
select doc_id, license, max(share) as contained, arg_max(start, share - start / 1e12)::bigint as first_word
from f where share >= {license_scan.CONTAINED} group by doc_id, license
"""


@query("op7_license_scan", _license_sql())
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(table(spark, sf_dir, "documents")).select(
        "doc_id", "license", "contained", "first_word"
    )


@query("op8_ngram_join")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_components(table(spark, sf_dir, "documents"))


@query("op9_source_mix")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.mix_plan(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source", "source_size", "target", "taken"
    )


@query("op10_bpe")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(TOKENIZER)
    out = bpe.encode(table(spark, sf_dir, "documents"), path, decoded=True)
    return out.select(
        "doc_id", "n_tokens", bpe.digest(F.col("ids")).alias("ids_sha256"), bpe.digest(F.col("decoded")).alias("decoded_sha256")
    )


def crc32_sql(value: str) -> str:
    """Unsigned CRC-32 of an ASCII text."""
    codes = f"list_transform(string_split({value}, ''), lambda c: ascii(c)::bigint)"
    shifted = "list_reduce(list_prepend(xor(a, b), [3988292384::bigint for i in range(8)]), lambda x, p: xor(x >> 1, p * (x & 1)))"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295::bigint, {codes}), lambda a, b: {shifted}))"


@query(
    "op11_prefix_trie",
    f"""
with t as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null
), c as (
    select conv_id, list({{'role': role, 'text': text}} order by turn nulls first, role, sha256(octet_length(encode(role)) || ':' || role || text)) as own,
           {crc32_sql('conv_id::varchar')} % 4 as h
    from t group by conv_id
), r as (
    select c.conv_id, list_concat(coalesce(b.own[1 : c.h], []), c.own[c.h + 1 :]) as turns
    from c left join c as b on b.conv_id = c.conv_id - c.conv_id % 20
), p as (
    select conv_id, d, turns[1 : d] as prefix, len(turns) as n,
           case when d = 0 then 0 else len(regexp_extract_all(turns[d].text, '[^\\x20\\x09-\\x0D]+')) end as words
    from (select *, unnest(range(0, len(turns) + 1)) as d from r)
), m as (
    -- a node is known by its smallest member and its depth
    select conv_id, d, n, words, min(conv_id) over (partition by d, prefix) as m from p
), g as (
    select m, d, count(*) as n_convs, max(words) as words,
           coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where n = d), '') as ends
    from m group by m, d
), e as (
    select distinct a.m as pm, a.d as pd, b.m, b.d from m a join m b on b.conv_id = a.conv_id and b.d >= a.d
), k as (
    select pm, pd, count(*) as n from e where d = pd + 1 group by pm, pd
)
select g.m as conv_id, g.d as depth, any_value(up.pm) as parent_conv_id, any_value(g.n_convs)::bigint as n_convs,
       coalesce(any_value(own.n), 0)::bigint as n_children,
       count(*) filter (where below.n is null)::bigint as n_leaves,
       sum((x.n_convs - 1) * x.words)::bigint as saved_tokens, sha256(any_value(g.ends)) as ends_sha256
from g
join e on e.pm = g.m and e.pd = g.d
join g as x on x.m = e.m and x.d = e.d
left join k as below on below.pm = e.m and below.pd = e.d
left join k as own on own.pm = g.m and own.pd = g.d
left join e as up on up.m = g.m and up.d = g.d and up.pd = g.d - 1
group by g.m, g.d
""",
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = stored(prefix_trie.sequences(table(spark, sf_dir, "conversations")), "turns")
    return prefix_trie.prefix_trie(prefix_trie.spliced(turns))


@query(
    "op12_suffix_dedup",
    f"""
with d as (
    select doc_id, hex(encode(coalesce(text, ''))) as t from documents
), w as (
    select doc_id, k, md5_number(substr(t, 2 * k + 1, 2 * {suffix_dedup.SPAN})) as string
    from (select *, unnest(range(0, len(t) // 2 - {suffix_dedup.SPAN} + 1)) as k from d)
), r as (
    select doc_id, k from w qualify count(*) over (partition by string) > 1
), s as (
    -- a run begins where no repeated string starts within reach
    select doc_id, k, sum(fresh) over (partition by doc_id order by k) as run
    from (select *, (k - coalesce(lag(k) over (partition by doc_id order by k), -1000000) > {suffix_dedup.SPAN})::int as fresh from r)
), u as (
    select doc_id, run, min(k) as start, max(k) + {suffix_dedup.SPAN} as stop from s group by doc_id, run
), g as (
    select doc_id, run, stop, lag(stop, 1, 0) over (partition by doc_id order by run) as after, start, t from u join d using (doc_id)
), p as (
    select doc_id, count(*) as n_spans, sum(stop - start) as n_removed, max(stop) as stop,
           string_agg(substr(t, 2 * after + 1, 2 * (start - after)), '' order by run) as before
    from g group by doc_id
)
select doc_id, (len(t) // 2)::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0)::bigint as n_spans,
       sha256(unhex(coalesce(before || substr(t, 2 * stop + 1), t))) as kept_sha256
from d left join p using (doc_id)
""",
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", bpe.digest(F.col("kept")).alias("kept_sha256"))


def _merkle_sql() -> str:
    """Levels and foldings by recursion."""
    lower = f"case when {crc32_sql('doc_id::varchar')} % 3 = 0 then translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') else text end"

    def leaf(text: str) -> str:
        values = ["doc_id::varchar", "source", "lang", "n_chars::varchar", text]
        return "sha256(" + " || ".join(f"coalesce(octet_length(encode({v})) || ':' || {v}, '-')" for v in values) + ")"

    return f"""
with recursive t as (
    select doc_id, lang, {leaf("text")} as leaf, {leaf("lowered")} as given
    from (select *, {lower} as lowered from documents)
), l as (
    select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as rank,
           count(*) over (partition by lang) as n
    from t
), v as (
    select 0 as h, lang, rank, n, leaf as digest from l
    union all
    select h + 1, lang, rank // 8, (n + 7) // 8, sha256(string_agg(digest, '' order by rank))
    from v where n > 1 group by h, lang, rank // 8, n
), s as (
    select lang, digest as subroot, row_number() over (order by lang is not null, encode(lang)) - 1 as place, count(*) over () as n
    from v where n = 1
), u as (
    select 0 as h, place as rank, n, subroot as digest from s
    union all
    select h + 1, rank // 8, (n + 7) // 8, sha256(string_agg(digest, '' order by rank))
    from u where n > 1 group by h, rank // 8, n
), e as (
    select 0 as top, h, lang, rank, n, digest from v where n > 1
    union all
    select 1, h, null, rank, n, digest from u where n > 1
), b as (
    select top, h, lang, rank,
           coalesce(string_agg(digest, '') over (run rows between unbounded preceding and 1 preceding), '') as before,
           coalesce(string_agg(digest, '') over (run rows between 1 following and unbounded following), '') as after
    from e window run as (partition by top, h, lang, rank // 8 order by rank)
), p as (
    select doc_id, leaf, lang, rank as first, 0 as h, rank, given as node, '' as others from l
    union all
    select doc_id, leaf, p.lang, first, p.h + 1, p.rank // 8, sha256(before || node || after), others || before || after
    from p join b on top = 0 and b.h = p.h and b.lang is not distinct from p.lang and b.rank = p.rank
), q as (
    select p.*, subroot, place from p join s on s.lang is not distinct from p.lang
    qualify row_number() over (partition by p.lang, first order by h desc) = 1
), w as (
    select doc_id, leaf, lang, first, subroot, 0 as h, place, node, others from q
    union all
    select doc_id, leaf, w.lang, first, subroot, w.h + 1, w.place // 8, sha256(before || node || after), others || before || after
    from w join b on top = 1 and b.h = w.h and b.rank = w.place
), z as (
    select * from w qualify row_number() over (partition by lang, first order by h desc) = 1
)
select doc_id, leaf, subroot, digest as root, sha256(others) as proof_sha256, node as folded_root, node = digest as verified
from z, u where u.n = 1
"""


@query("op13_merkle_manifest", _merkle_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(table(spark, sf_dir, "documents"))
