"""The corpus operators on the given tables, with SQL where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlane.llm import (
    line_quality,
    mixing,
    packing,
    pieces,
    prefix_tree,
    quality_rules,
    repeats,
    secrets,
    simhash,
    spelling,
    token_counts,
    topk,
    warc,
)
from rosterlane.llm.common import with_shared_folder, work_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of (spark, folder) under its name."""

    def register(build):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            with_shared_folder(spark)
            return build(spark, folder)

        QUERIES[build.__name__] = run
        if sql is not None:
            ORACLE[build.__name__] = sql
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


WORDS_SQL = r"""list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'),
  lambda w: w <> '')"""


@query(rf"""with d as (
    select doc_id, coalesce(text, '') as t, {WORDS_SQL} as ws,
      list_filter(string_split(coalesce(text, ''), chr(10)),
        lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as ls
    from documents),
  windows as (select doc_id, ws, unnest(range(1, len(ws) - 3)) as pos from d where len(ws) >= 5),
  counted as (select doc_id, pos, count(*) over (partition by doc_id,
    array_to_string(list_slice(ws, pos, pos + 4), ' ')) as n from windows),
  covered as (select doc_id, count(distinct place) as n from
    (select doc_id, unnest(range(pos, pos + 5)) as place from counted where n > 1) group by doc_id),
  base as (
    select d.doc_id, t, ws, len(ws)::bigint as n_words,
      length(array_to_string(ws, ''))::bigint as word_chars,
      length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
      len(ls)::bigint as n_lines, (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines,
      coalesce(covered.n, 0)::bigint as n_repeat_words
    from d left join covered on covered.doc_id = d.doc_id),
  judged as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from base)
  select doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed,
    not (base_failed or 10 * n_symbols > n_words
      or word_chars < 2 * n_words or word_chars > 15 * n_words
      or 10 * n_dup_lines > 4 * n_lines
      or 5 * (length(t) - length(replace(t, '!', ''))) > n_words
      or 10 * len(regexp_extract_all(t, '(?:^|\n)[\x20\t]*[-*•]')) > 9 * n_lines
      or 10 * len(regexp_extract_all(t, '(?:\.\.\.|…)[\x20\t]*(?:\n|$)')) > 3 * n_lines
      or 10 * len(list_filter(ws, lambda w: not regexp_matches(w, '\p{{L}}'))) > 4 * n_words
      or 2 * length(regexp_replace(t, '[^\p{{Lu}}]', '', 'g')) > word_chars) as kept
  from judged""")
def op10_quality_rules(spark, folder):
    return quality_rules.quality_rules(table(spark, folder, "documents"))


@query()
def op8_secrets(spark, folder):
    return secrets.secret_report(table(spark, folder, "documents"))


def base_matches_sql(kind: str, place: int, regex: str, group: int, least: int) -> str:
    """Matches of one kind with their offsets: the lengths of what is between and of those before."""
    pattern = "'" + regex.replace("'", "''") + "'"
    return f"""select doc_id, {place} as place, '{kind}' as kind, length(g[i]) >= {least} as found,
      (list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0))::bigint as start,
      length(m[i]) as size
    from (select doc_id, m, g, gaps, unnest(range(1, len(m) + 1)) as i from (
      select doc_id, regexp_extract_all(t, {pattern}) as m, regexp_extract_all(t, {pattern}, {group}) as g,
        string_split_regex(t, {pattern}) as gaps from texts))"""


BASE_SPANS_SQL = " union all ".join(
    base_matches_sql(p.kind, place, p.regex, p.group, p.least) for place, p in enumerate(secrets.BASE)
)
BASE_COUNTS_SQL = ", ".join(
    f"count(*) filter (kind = '{p.kind}') as n_{p.kind}" for p in secrets.BASE
)


@query(f"""with texts as (select doc_id, coalesce(text, '') as t from documents),
  spans as (select * from ({BASE_SPANS_SQL}) where found)
  select texts.doc_id, {BASE_COUNTS_SQL}, sha256(coalesce(string_agg(
    kind || ':' || start || ':' || (start + size), ',' order by start, place), '')) as base_sha256
  from texts left join spans on spans.doc_id = texts.doc_id group by texts.doc_id""")
def secret_counts(spark, folder):
    """The base columns of the report, which SQL can express."""
    report = secrets.secret_report(table(spark, folder, "documents"))
    return report.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")


@query("""with v as (
    select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
    from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
  scored as (
    select q.vec_id as query_id, c.vec_id as vec_id,
      list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::bigint as score
    from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0),
  ranked as (
    select query_id, row_number() over (partition by query_id order by score desc, vec_id) as rank,
      vec_id, score from scored)
  select query_id, rank::integer as rank, vec_id, score from ranked where rank <= 5""")
def op9_topk(spark, folder):
    vectors = table(spark, folder, "embeddings")
    return topk.exact_top_k(vectors, F.col("vec_id") % 50 == 0)


# Base 32 of a hexadecimal digest: five digits are twenty bits, or four characters.
BASE32_SQL = """array_to_string(list_transform(range(8), lambda g: array_to_string(list_transform([15, 10, 5, 0],
  lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (('0x' || substr({0}, g * 5 + 1, 5))::integer >> s) % 32 + 1, 1)), '')), '')"""


@query(f"""with p as (select page_id, coalesce(html, '') as body from pages),
  grouped as (select page_id, body, sha1(body) as digest, max(page_id) over (partition by body) as last from p)
  select page_id, strlen(body)::bigint as payload_bytes, {BASE32_SQL.format("digest")} as payload_digest,
    case when page_id = last then 'response' else 'revisit' end as record_type,
    case when page_id <> last then last end as refers_to from grouped""")
def op5_warc(spark, folder):
    pages = table(spark, folder, "pages")
    records = warc.archived(pages, work_folder(spark, "warc"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def mixing_sql(evenness: float, max_repeats: float, block_tokens: int, block_rows: int) -> str:
    """The stream of ``op7_mixing``: shares, the bisected exponent, weights, and the block permutations."""
    number = "('0x' || left({}, {}))::bigint"
    dealt = number.format("md5(concat_ws('|', coalesce(doc_id::varchar, 'null'), digest, copy, 0))", 15)
    entropy = """(select log2(sum(pow(s, {0}))) - {0} * sum(pow(s, {0}) * log2(s)) / sum(pow(s, {0})) from shares)"""
    middle = "((low + high) / 2)"
    return rf"""with recursive d as (
    select doc_id, source, md5(coalesce(text, '')) as digest, len({WORDS_SQL})::bigint as tokens,
      row_number() over (partition by doc_id, source, md5(coalesce(text, ''))) - 1 as copy from documents),
  totals as (select source, sum(tokens)::bigint as total, count(*) as n from d group by source),
  shares as (select source, total / (select sum(total) from totals) as s from totals where total > 0),
  goal as (select {entropy.format("1.0::double")} as own, {entropy.format("0.0::double")} as equal),
  bisected(step, low, high) as (
    select 0, 0.0::double, 1.0::double
    union all select step + 1, case when h > own + {evenness} * (equal - own) then {middle} else low end,
      case when h > own + {evenness} * (equal - own) then high else {middle} end
    from (select step, low, high, {entropy.format(middle)} as h from bisected) as tried, goal where step < 60),
  limited(step, low, high) as (
    select 0, 0.0::double, 1.0::double
    union all select step + 1, case when r > {max_repeats} then {middle} else low end,
      case when r > {max_repeats} then high else {middle} end
    from (select step, low, high,
      (select pow(min(s), {middle} - 1) / sum(pow(s, {middle})) from shares) as r from limited) as tried where step < 60),
  chosen as (select greatest((select high from bisected where step = 60), (select high from limited where step = 60)) as exponent),
  plan as (
    select totals.source, total, exponent, greatest(1, ceil(total / {block_tokens}), ceil(n / {block_rows}))::bigint as blocks,
      coalesce(pow(s, exponent) / (select sum(pow(s, exponent)) from shares), 0.0) as weight,
      coalesce(round(pow(s, exponent) / (select sum(pow(s, exponent)) from shares) / s, 9), 1.0) as reads
    from chosen, totals left join shares on shares.source is not distinct from totals.source),
  dealt as (
    select d.*, total, exponent, weight, reads, blocks, {dealt} % blocks as block
    from d join plan on plan.source is not distinct from d.source),
  placed as (
    select *, coalesce(sum(tokens) over (partition by source, block
      order by md5(concat_ws('|', coalesce(doc_id::varchar, 'null'), digest, copy, block, 1)), doc_id, digest, copy
      rows between unbounded preceding and 1 preceding), 0) as before from dealt),
  passes as (
    select source, block, unnest(range(greatest(ceil(reads)::bigint, 1))) as epoch, sum(tokens) as block_tokens
    from dealt group by source, block, reads),
  starts as (
    select *, coalesce(sum(block_tokens) over (partition by source, epoch
      order by md5(concat_ws('|', block, epoch, 2)), block
      rows between unbounded preceding and 1 preceding), 0) as start from passes),
  read as (
    select placed.*, epoch, epoch * total + start + before as spot, reads * total as quota from placed join starts
      on starts.source is not distinct from placed.source and starts.block = placed.block)
  select doc_id, source, tokens, epoch::integer as epoch, block,
    case when quota > 0 then least(spot / quota, 1 - pow(2, -53)) else 0.0 end as position, exponent, weight
  from read where epoch + 1 <= reads or spot < quota"""


# Halfway from the sources' own shares to equal ones, and no source read more than four times.
EVENNESS, MAX_REPEATS = 0.5, 4.0


@query(mixing_sql(EVENNESS, MAX_REPEATS, mixing.BLOCK_TOKENS, mixing.BLOCK_ROWS))
def op7_mixing(spark, folder):
    """A stream as long as the data."""
    return mixing.mixture(table(spark, folder, "documents"), evenness=EVENNESS, max_repeats=MAX_REPEATS)


@query()
def op6_simhash(spark, folder):
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select(
        "doc_id", simhash.hex_print(F.col("fp")).alias("fingerprint"), "component_id"
    )


@query()
def op2_line_quality(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = line_quality.scored(docs, table(spark, folder, "labels"))
    return scored.select(
        "doc_id",
        line_quality.held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query(rf"""with d as (select doc_id, {WORDS_SQL} as ws from documents),
  words as (select doc_id, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as pos from d),
  windows as (select doc_id, ws, unnest(range(1, len(ws) - 18)) as pos from d where len(ws) >= 20),
  numbered as (select doc_id, pos, row_number() over (
    partition by array_to_string(list_slice(ws, pos, pos + 19), ' ') order by doc_id, pos) as n
    from windows),
  gone as (select distinct doc_id, pos from
    (select doc_id, unnest(range(pos, pos + 20)) as pos from numbered where n > 1)),
  kept as (select words.doc_id, count(gone.pos) as n_removed,
      string_agg(word, ' ' order by words.pos) filter (where gone.pos is null) as text
    from words left join gone on gone.doc_id = words.doc_id and gone.pos = words.pos
    group by words.doc_id)
  select d.doc_id, len(ws)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed,
    sha256(coalesce(kept.text, '')) as kept_sha256
  from d left join kept on kept.doc_id = d.doc_id""")
def op1_repeats(spark, folder):
    cleaned = repeats.without_repeats(table(spark, folder, "documents"))
    removed = "aggregate(removed_spans, 0L, (n, s) -> n + (s.end - s.start))"
    return cleaned.select(
        "doc_id",
        "n_words",
        F.expr(removed).alias("n_removed"),
        F.sha2("text", 256).alias("kept_sha256"),
    )


@query()
def op3_pieces(spark, folder):
    """Encoded, and decoded again."""
    coded = pieces.coded(table(spark, folder, "documents").select("doc_id", "text"))
    n_pieces = F.size("ids").cast("long").alias("n_pieces")
    return coded.select("doc_id", n_pieces, "ids", "round_trip")


@query()
def op4_token_counts(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return token_counts.with_token_counts(docs).select("doc_id", "n_tokens")


@query()
def op13_packing(spark, folder):
    sequences = packing.packed(table(spark, folder, "documents"))
    return sequences.select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def crc32_sql(values: str) -> str:
    """The CRC-32 of a list of byte values: each is mixed in, then eight times a bit is shifted out."""
    steps = f"flatten(list_transform({values}, lambda b: [b, -1, -1, -1, -1, -1, -1, -1, -1]))"
    shifted = "xor(c >> 1, 3988292384 * (c & 1))"
    return f"""xor(4294967295, list_reduce({steps},
      lambda c, x: case when x >= 0 then xor(c, x) else {shifted} end, 4294967295))"""


LATIN_BYTES_SQL = """flatten(list_transform(string_split({0}, ''),
  lambda l: case when ord(l) < 128 then [ord(l)::bigint] else [195::bigint, (ord(l) - 64)::bigint] end))"""


@query(rf"""with recursive runs as (
    select doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run
    from (select doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) as run from documents)),
  counted as (select doc_id, run, count(*) as n from runs where length(run) >= 5 group by doc_id, run),
  hashed as (select run, n,
    {crc32_sql(LATIN_BYTES_SQL.format("(coalesce(doc_id::varchar, '') || ':' || run)"))} as h from counted),
  lost as (select n, case when h % 97 = 0
      then left(run, (h % length(run))::int) || substr(run, (h % length(run))::int + 2)
      else run end as word from hashed),
  words as (select word, sum(n)::bigint as n from lost where length(word) >= 5
    group by word having sum(n) >= 3),
  gaps as (select word, n, unnest(range(1, length(word) + 1)) as i from words),
  patterns as (select word, n, i, left(word, (i - 1)::int) || '_' || substr(word, i + 1) as pattern,
    left(word, (i - 1)::int) || substr(word, i + 1) as shorter from gaps),
  near as (
    select a.word, b.word as other, b.n as other_n from patterns a join patterns b
      on a.pattern = b.pattern and a.i = b.i and a.word <> b.word
    union select p.word, w.word, w.n from patterns p join words w on p.shorter = w.word
    union select w.word, p.word, p.n from patterns p join words w on p.shorter = w.word),
  ranked as (select *, count(*) over (partition by word) as n_near,
    row_number() over (partition by word order by other_n desc, other) as place from near),
  formed as (select words.word, n, coalesce(n_near, 0)::bigint as n_near,
      case when other_n >= 2 * n then other end as form, case when other_n >= 2 * n then other_n end as form_n
    from words left join ranked on ranked.word = words.word and place = 1),
  path as (
    select word, word as at from formed
    union all select path.word, form from path join formed on formed.word = path.at where form is not null),
  roots as (
    select path.word, path.at as root from path join formed on formed.word = path.at where form is null)
  select formed.word, form, root, n, n_near, form_n from formed join roots on roots.word = formed.word""")
def op12_spelling(spark, folder):
    return spelling.variant_groups(table(spark, folder, "documents"))


ASCII_BYTES_SQL = "list_transform(string_split({0}, ''), lambda l: ord(l)::bigint)"


@query(f"""with own as (
    select conv_id, list(struct_pack(role := coalesce(role, ''), text := coalesce(text, ''))
      order by turn nulls first, role, text) as turns
    from conversations where conv_id is not null group by conv_id),
  hashed as (select *, {crc32_sql(ASCII_BYTES_SQL.format("conv_id::varchar"))} % 6 as h from own),
  built as (
    select c.conv_id, list_concat(coalesce(list_slice(base.turns, 1, c.h), []), list_slice(c.turns, c.h + 1, len(c.turns))) as turns
    from hashed c left join own base on base.conv_id = c.conv_id - c.conv_id % 100),
  prefixes as (
    select conv_id, unnest(range(0, len(turns) + 1)) as depth, turns from built),
  named as (
    select conv_id, depth, list_slice(turns, 1, depth)::varchar as node, list_slice(turns, 1, depth - 1)::varchar as above,
      case when depth > 0 then length(turns[depth].text) else 0 end as chars, depth = len(turns) as ending
    from prefixes),
  nodes as (
    select depth, node, any_value(above) as above, any_value(chars) as chars, min(conv_id) as conv_id, count(*) as n_convs,
      string_agg(conv_id::varchar, ',' order by conv_id) filter (ending) as ended
    from named group by depth, node),
  kids as (select depth - 1 as depth, above as node, count(*) as n_children from nodes where depth > 0 group by 1, 2),
  counted as (
    select nodes.*, coalesce(n_children, 0) as n_children from nodes left join kids using (depth, node)),
  -- Every node counts for the nodes on the path of its first conversation.
  paths as (
    select upper.depth, upper.node, sum((n_convs - 1) * counted.chars) as saved, sum((n_children = 0)::int) as leaves
    from counted join named upper on upper.conv_id = counted.conv_id and upper.depth <= counted.depth
    group by upper.depth, upper.node)
  select c.conv_id, c.depth::bigint as depth, p.conv_id as parent_conv_id, c.n_convs, c.n_children,
    paths.leaves::bigint as n_leaves, paths.saved::bigint as saved_tokens, sha256(coalesce(c.ended, '')) as ends_sha256
  from counted c join paths using (depth, node)
    left join counted p on p.depth = c.depth - 1 and p.node = c.above and c.depth > 0""")
def op11_prefix_tree(spark, folder):
    tree = prefix_tree.prefix_tree(table(spark, folder, "conversations"))
    ended = prefix_tree.end_digests(tree.ends)
    none = F.sha2(F.lit(""), 256)
    return tree.nodes.join(ended.hint("merge"), "node", "left").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", none).alias("ends_sha256"),
    )
