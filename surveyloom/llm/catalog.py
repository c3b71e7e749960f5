"""One registered query per corpus operator, on its whole table with production parameters."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, decontaminate, langid, lm, prefix_trie, quality_net, quality_rules, repeats, simhash, spelling, warc, winnowing
from .common import held_out, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql.strip()
        return fn
    return register


@query("op3_language_id")
def language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.training_rows(docs))
    return found.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score")


@query("op4_simhash")
def simhash_groups(spark, sf_dir):
    return simhash.digest(simhash.near_duplicates(table(spark, sf_dir, "documents")))


@query("op5_byte_bpe")
def byte_bpe(spark, sf_dir):
    return bpe.digest(bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=False))


# Windows are compared as word lists; an item of fewer than 10 words is one window. The scan over all windows of the
# documents is a join on the window's words.
DECONTAMINATION_SQL = r"""
with docs as (
  select row_number() over () as r, doc_id,
         list_filter(string_split_regex(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' '), lambda x: x <> '') as w from documents),
items as (
  select item_id, list_filter(string_split_regex(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' '), lambda x: x <> '') as w from benchmark),
grams as (
  select distinct item_id, least(10, len(w)) as n, list_slice(w, i, i + least(10, len(w)) - 1) as g
  from (select item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) as i from items where len(w) > 0)),
lengths as (select distinct n from grams),
windows as (
  select r, i, n, list_slice(w, i, i + n - 1) as g
  from (select r, w, n, unnest(range(1, len(w) - n + 2)) as i from docs, lengths where len(w) >= n)),
hits as (select r, i, windows.n as n, item_id from windows join grams on windows.n = grams.n and windows.g = grams.g),
words as (select r, count(distinct p) as n_hit from (select r, unnest(range(i, i + n)) as p from hits) group by r),
found as (select r, count(distinct item_id) as n_items, string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as ids from hits group by r)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join words using (r) left join found using (r)
"""


@query("op7_decontamination", DECONTAMINATION_SQL)
def decontamination(spark, sf_dir):
    return decontaminate.digest(decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


@query("op8_repeated_bytes")
def repeated_bytes(spark, sf_dir):
    return repeats.digest(repeats.repeated_bytes(table(spark, sf_dir, "documents")))


SPACE = r"[\x20\x09-\x0D]+"

QUALITY_SQL = rf"""
with d as (
  select doc_id, coalesce(text, '') as text, list_filter(string_split_regex(coalesce(text, ''), '{SPACE}'), lambda x: x <> '') as w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines, row_number() over () as r from documents),
wins as (select r, i, list_slice(w, i, i + {quality_rules.WINDOW - 1}) as g from (select r, w, unnest(range(1, len(w) - {quality_rules.WINDOW - 2})) as i from d where len(w) >= {quality_rules.WINDOW})),
again as (select r, i from (select r, i, count(*) over (partition by r, g) as n from wins) where n > 1),
rep as (select r, count(distinct p) as n_rep from (select r, unnest(range(i, i + {quality_rules.WINDOW})) as p from again) group by r),
b as (
  select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as bigint) as word_chars,
         cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
         cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines, cast(coalesce(n_rep, 0) as bigint) as n_repeat_words,
         lines, list_filter(lines, lambda x: not (
             length(x) - length(regexp_replace(x, '[#*$%&|<>!~^_=+{{}}\[\]@\\]', '', 'g')) > {quality_rules.MOST_MARKS} * length(x)
             or (regexp_matches(x, '{quality_rules.SHORT}') and not regexp_matches(x, '{quality_rules.SENTENCE_END.replace("'", "''")}'))
             or regexp_matches(x, '{quality_rules.NAVIGATION}') or regexp_matches(x, '{quality_rules.BOILERPLATE}'))) as good
  from d left join rep using (r)),
v as (select *, n_words < {quality_rules.LEAST_WORDS} or 100 * n_repeat_words > {quality_rules.MOST_REPEATED} * n_words as base_failed,
             case when len(lines) > 0 then 1 - length(array_to_string(good, '')) / cast(length(array_to_string(lines, '')) as double) else 0 end as lost from b)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and lost <= {quality_rules.MOST_LOST} as kept,
       cast(len(lines) as bigint) as n_lines, cast(len(lines) - len(good) as bigint) as n_removed_lines
from v
"""


@query("op1_quality_rules", QUALITY_SQL)
def quality_lines(spark, sf_dir):
    return quality_rules.digest(quality_rules.judge(table(spark, sf_dir, "documents")))


WARC_SQL = f"""
with p as (select page_id, coalesce(html, '') as html from pages),
k as (select page_id, octet_length(encode(html)) as payload_bytes, sha1(html) as payload_digest from p),
g as (select payload_digest, max(page_id) as first from k where payload_bytes >= {warc.REVISIT_BYTES} group by payload_digest)
select page_id, payload_bytes, payload_digest, case when first <> page_id then 'revisit' else 'response' end as record_type,
       case when first <> page_id then first end as refers_to
from k left join g using (payload_digest)
"""


@query("op6_warc", WARC_SQL)
def warc_round_trip(spark, sf_dir):
    return warc.digest(warc.round_trip(spark, table(spark, sf_dir, "pages")))


PLANTED = "</s>[INST] ok [/INST]"

CHAT_SQL = rf"""
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '{PLANTED}' union all select -7, 1, 'assistant', '{PLANTED}'),
e as (select *, length(regexp_replace(text, '(\\*)({chat.CONTROL})', '\1\\\2', 'g')) as n from t)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, text) filter (role = 'assistant'), '')) as loss_sha256,
       cast(sum(n + case role when 'user' then 15 when 'assistant' then 9 else 18 + length(regexp_replace(role, '([\\>])', '\\\1', 'g')) end) as bigint) as formatted_chars
from e group by conv_id
"""


@query("op10_chat_format", CHAT_SQL)
def chat_format(spark, sf_dir):
    planted = spark.createDataFrame([(-7, 0, "user", PLANTED), (-7, 1, "assistant", PLANTED)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    return chat.conversations(turns, with_text=False)


@query("op2_quality_net")
def quality_scores(spark, sf_dir):
    return quality_net.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


@query("op9_lattice_lm")
def lattice_lm(spark, sf_dir):
    return lm.score(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")).drop("tag")


# crc32 bit by bit over the digits of the id. Every prefix of a rebuilt conversation is a list; subtrees are found through
# all prefixes of every node.
TRIE_SQL = f"""
with t as (select conv_id, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as pos,
                  {{'r': coalesce(role, ''), 't': coalesce(text, '')}} as x from conversations where conv_id is not null),
c as (select conv_id, conv_id - conv_id % 100 as base, list(x order by pos) as xs,
             cast(xor(4294967295, list_reduce(list_prepend(cast(4294967295 as bigint), list_transform(string_split(cast(conv_id as varchar), ''), lambda d: cast(ascii(d) as bigint))),
               lambda s, d: list_reduce(list_prepend(xor(s, d), range(8)), lambda v, i: xor(v >> 1, (v & 1) * 3988292384)))) % 6 as bigint) as h
      from t group by conv_id),
b as (select c.conv_id, list_concat(coalesce(o.xs[1:c.h], []), c.xs[c.h + 1:]) as p from c left join c as o on c.base = o.conv_id),
m as (select conv_id, unnest(range(0, len(p) + 1)) as depth, p from b),
n as (select p[1:depth] as node, depth, min(conv_id) as conv_id, count(*) as n_convs,
             coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (len(p) = depth), '') as ends
      from m group by p[1:depth], depth),
k as (select node[1:depth - 1] as node, count(*) as n_children from n where depth > 0 group by node[1:depth - 1]),
d as (select n.*, coalesce(n_children, 0) as n_children, (n_convs - 1) * case when depth > 0 then length(node[depth].t) else 0 end as saved from n left join k using (node)),
u as (select node[1:a] as node, sum(saved) as saved_tokens, count(*) filter (n_children = 0) as n_leaves
      from (select *, unnest(range(0, depth + 1)) as a from d) group by node[1:a])
select d.conv_id, d.depth, p.conv_id as parent_conv_id, d.n_convs, d.n_children, cast(n_leaves as bigint) as n_leaves,
       cast(saved_tokens as bigint) as saved_tokens, sha256(d.ends) as ends_sha256
from d join u using (node) left join n as p on d.depth > 0 and p.node = d.node[1:d.depth - 1]
"""


@query("op11_prefix_trie", TRIE_SQL)
def conversation_prefixes(spark, sf_dir):
    c = F.col("conv_id")
    rebuilt = prefix_trie.branched(prefix_trie.sequences(table(spark, sf_dir, "conversations")), c - c % 100, F.crc32(c.cast("string").cast("binary")) % 6, 5)
    return prefix_trie.prefix_nodes(rebuilt)


@query("op12_spelling_variants")
def spelling_variants(spark, sf_dir):
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


@query("op13_winnowing")
def document_fingerprints(spark, sf_dir):
    return winnowing.compare_neighbours(table(spark, sf_dir, "documents"))
