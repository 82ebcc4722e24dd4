"""Scans of texts for secrets, in SQL functions only.

Three patterns give the base spans. The entropy method adds more: candidate strings are long runs of
hexadecimal digits, wherever they lie, and long runs of key-like characters; over each of them a
window slides, whose Shannon entropy is kept up by adding the count of the character that enters and
taking off the one that leaves. A candidate with a window above the threshold of its character class
is a secret. Windows that touch a match of an allow-list pattern are explained by it and do not count.

Offsets are code points, ends exclusive. Texts of any length and with any number of secrets take time
in proportion: candidates are cut into overlapping pieces of bounded length before a window slides over
them, lists are built block by block (``scanned``), and texts are taken apart in chunks.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlane.llm.common import fresh


@dataclass(frozen=True)
class Pattern:
    """A kind of secret by a pattern; of a match, ``group`` has ``least`` characters or more."""

    kind: str
    regex: str
    group: int
    least: int


# Runs that a class repeats greedily are asked for at full length at once, which finds the same.
BASE = (
    Pattern(
        "assign",
        r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        2,
        12,
    ),
    Pattern("access", r"AKIA[A-Z0-9]{14,}", 0, 18),
    Pattern("hex", r"[0-9a-f]{16,}", 0, 16),
)


@dataclass(frozen=True)
class CharacterClass:
    """Strings over ``alphabet`` with a window of more than ``bits`` Shannon entropy are secrets.

    ``candidate`` finds the strings, also inside longer ones of another class.
    """

    kind: str
    regex: str
    alphabet: str
    bits: float
    candidate: str


DIGITS = "0123456789"
LOWER = "abcdefghijklmnopqrstuvwxyz"
CANDIDATE = r"[A-Za-z0-9+/=_-]{20,}"
CLASSES = (
    CharacterClass(
        "hex_entropy", r"^[0-9A-Fa-f]+$", DIGITS + "abcdefABCDEF", 3.0, r"[0-9A-Fa-f]{20,}"
    ),
    CharacterClass(
        "base64_entropy",
        r"^[A-Za-z0-9+/=_-]+$",
        DIGITS + LOWER + LOWER.upper() + "+/=_-",
        3.8,
        CANDIDATE,
    ),
)
WINDOW = 20

# What is no secret: words and compounds, numbers, paths of words, placeholders. Letters are words but
# for segments of a window's length with a small letter between two capitals.
ALLOWED = (
    r"^(?!(?:[A-Za-z/_=-]*[/_=-])?(?=[A-Za-z]{20})[A-Za-z]*[A-Z][a-z][A-Z])[A-Za-z/_=-]+$",
    r"^[0-9/+=_-]+$",
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"(?i)example|placeholder|changeme|x{4,}|0{8,}|1234567",
)

SPANS = "array<struct<start:int,place:int,end:int,kind:string>>"

# Elements of a list that is built one by one; longer lists are lists of such blocks.
BLOCK = 256
# Characters of a candidate that windows start in, and of a text's chunks.
PIECE = 108
CHUNK = 4096


def literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def bound(value: str, name: str, body: str) -> str:
    """SQL of ``body`` in which ``name`` stands for a value that is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def scanned(items: str, state: str, step: str, kind: str) -> str:
    """SQL of the array that a pass over ``items`` collects.

    ``step`` is SQL over the state ``a.state`` and the element ``x``: a struct of the next ``state`` and
    of ``out``, an array of type ``kind`` to add. Adding to a list copies it, so the pass fills blocks
    and adds those to a list of blocks.
    """
    empty = f"cast(array() as {kind})"
    added = bound(step, "y", "named_struct('state', y.state, 'out', a.out || y.out)")
    filled = f"aggregate(b, named_struct('state', o.state, 'out', {empty}), (a, x) -> {added})"
    merged = bound(filled, "f", "named_struct('state', f.state, 'out', o.out || array(f.out))")
    blocks = bound(
        items,
        "all",
        f"transform(sequence(0, greatest(size(all) - 1, 0) div {BLOCK}), n -> slice(all, n * {BLOCK} + 1, {BLOCK}))",
    )
    start = f"named_struct('state', {state}, 'out', cast(array() as array<{kind}>))"
    return f"aggregate({blocks}, {start}, (o, b) -> {merged}, o -> flatten(o.out))"


def matches(text: str, regex: str, condition: str, place: int, kind: str, group: int = 0) -> str:
    """SQL of the array of spans (start, place, end, kind) of a pattern's matches.

    What lies between matches gives their offsets: a match starts where the parts before it end.
    ``condition`` is SQL over ``z``, the match ``z.m`` and its group ``z.g``.
    """
    pattern = literal(regex)
    found = f"regexp_extract_all({text}, {pattern}, 0)"
    groups = found if group == 0 else f"regexp_extract_all({text}, {pattern}, {group})"
    zipped = f"arrays_zip(slice(split({text}, {pattern}, -1), 1, size({found})), {found}, {groups})"
    span = (
        f"named_struct('start', a.state + length(x.`0`), 'place', {place},"
        f" 'end', a.state + length(x.`0`) + length(x.`1`), 'kind', '{kind}')"
    )
    # In an array of one, so that the condition can name the match and its group.
    kept = f"exists(array(named_struct('m', x.`1`, 'g', x.`2`)), z -> {condition})"
    step = (
        "named_struct('state', a.state + length(x.`0`) + length(x.`1`), 'out',"
        f" if({kept}, array({span}), cast(array() as {SPANS})))"
    )
    return f"if({text} rlike {pattern}, {scanned(zipped, '0', step, SPANS)}, cast(array() as {SPANS}))"


def pieces(candidate: str) -> str:
    """SQL of overlapping pieces of a string that have all its windows, and no others."""
    tail = WINDOW - 1
    grown = f"transform(ps, (p, i) -> concat(p, left(coalesce(get(ps, i + 1), ''), {tail})))"
    cut = bound(f"regexp_extract_all({candidate}, '(?s).{{1,{PIECE}}}', 0)", "ps", grown)
    return f"filter({cut}, p -> length(p) >= least({WINDOW}, length({candidate})))"


def window_entropy(candidate: str, alphabet: str, window: int = WINDOW) -> str:
    """SQL of the highest Shannon entropy, in bits, of a window sliding over a string.

    The state holds a count per character of the alphabet and the sum of c * log2(c) over them; a
    step changes the counts of two characters and what they add to the sum. A string shorter than
    the window is one window of its own length.
    """
    at = f"locate(substring({candidate}, i, 1), '{alphabet}')"
    gone = f"if(i > {window}, locate(substring({candidate}, i - {window}, 1), '{alphabet}'), 0)"
    size = f"least({window}, length({candidate}))"

    def part(count: str) -> str:
        return f"if({count} > 0, ({count}) * log2({count}), 0D)"

    # Taking off first, then adding; a character that leaves and enters at once ends where it was.
    less = "get(s.counts, s.gone - 1)"
    taken = (
        "named_struct('counts', if(s.gone = 0, s.counts, transform(s.counts, (c, j) ->"
        f" if(j = s.gone - 1, c - 1, c))), 'total', if(s.gone = 0, s.total, s.total -"
        f" {part(less)} + {part(f'{less} - 1')}), 'best', s.best, 'into', s.into)"
    )
    more = "get(t.counts, t.into - 1)"
    added = (
        "named_struct('counts', transform(t.counts, (c, j) -> if(j = t.into - 1, c + 1, c)),"
        f" 'total', t.total - {part(more)} + {part(f'{more} + 1')}, 'best', t.best)"
    )
    full = f"log2({size}) - u.total / {size}"
    scored = (
        "named_struct('counts', u.counts, 'total', u.total, 'best',"
        f" if(i >= {size}, greatest(u.best, {full}), u.best))"
    )
    state = f"named_struct('counts', a.counts, 'total', a.total, 'best', a.best, 'gone', {gone}, 'into', {at})"
    step = (
        f"element_at(transform(transform(transform(array({state}), s -> {taken}), t -> {added}),"
        f" u -> {scored}), 1)"
    )
    start = f"named_struct('counts', array_repeat(0, {len(alphabet)}), 'total', 0D, 'best', 0D)"
    return f"aggregate(sequence(1, length({candidate})), {start}, (a, i) -> {step}, a -> a.best)"


def secret_condition(
    kind: CharacterClass, before: Sequence[CharacterClass], allowed: Sequence[str]
) -> str:
    """SQL over a candidate ``z.m``: of this class and of none before, and random in a window that
    touches no match of an allowed pattern."""
    tests = [f"z.m rlike {literal(kind.regex)}"]
    tests += [f"not z.m rlike {literal(other.regex)}" for other in before]
    parts = "array(z.m)"
    if allowed:
        explained = "|".join(f"(?:{pattern})" for pattern in allowed)
        parts = f"filter(split(z.m, {literal(explained)}, -1), w -> length(w) >= {WINDOW})"
    windows = f"exists({pieces('w')}, p -> {window_entropy('p', kind.alphabet)} > {kind.bits})"
    random = f"exists({parts}, w -> {windows})"
    return " and ".join([*tests, random])


def secret_spans(
    docs: DataFrame,
    text: str = "text",
    patterns: Sequence[Pattern] = BASE,
    classes: Sequence[CharacterClass] = CLASSES,
    allowed: Sequence[str] = ALLOWED,
    name: str = "secrets",
) -> DataFrame:
    """Add an array of all spans (start, place, end, kind), ordered by start, then kind as listed.

    Base spans all stay; an entropy span is added unless a base span or a longer entropy span covers
    it. Null texts count as empty and have no spans. Rows and their other columns stay as they are,
    repeated rows too; an empty table stays empty. A single run of any length, and any number of spans in
    a text, are searched whole.
    """
    body, found, random = fresh(docs, f"{name} body", f"{name} base", f"{name} random")
    base = [
        matches(f"`{body}`", p.regex, f"length(z.g) >= {p.least}", i, p.kind, p.group)
        for i, p in enumerate(patterns)
    ]
    added = [
        matches(
            f"`{body}`",
            c.candidate,
            secret_condition(c, classes[:i], allowed),
            len(patterns) + i,
            c.kind,
        )
        for i, c in enumerate(classes)
    ]
    searched = docs.withColumn(body, F.expr(f"coalesce({quoted(text)}, '')")).withColumns(
        {
            found: F.expr(f"concat({', '.join(base)})"),
            random: F.expr(f"concat({', '.join(added)})"),
        }
    )
    spans = F.expr(f"sort_array(concat(`{found}`, {uncovered(quoted(found), quoted(random))}))")
    return searched.withColumn(name, spans).drop(body, found, random)


def uncovered(base: str, random: str) -> str:
    """SQL of the entropy spans that neither a base span nor a longer entropy span covers.

    In the order of starts, longer ones first and base spans before all, a span is covered if one
    before it reaches as far. Equal entropy spans don't cover each other.
    """

    def marked(spans: str, late: int) -> str:
        return (
            f"transform({spans}, r -> named_struct('start', r.start, 'late', {late}, 'less', -r.end,"
            " 'place', r.place, 'end', r.end, 'kind', r.kind))"
        )

    ordered = f"sort_array(concat({marked(base, 0)}, {marked(random, 1)}))"
    same = "x.start = a.state.start and x.end = a.state.end"
    reach = f"if({same}, a.state.reach, greatest(a.state.reach, a.state.end))"
    span = "named_struct('start', x.start, 'place', x.place, 'end', x.end, 'kind', x.kind)"
    after_base = (
        "named_struct('base', greatest(a.state.base, x.end), 'reach', a.state.reach,"
        " 'start', a.state.start, 'end', a.state.end)"
    )
    after_random = f"named_struct('base', a.state.base, 'reach', {reach}, 'start', x.start, 'end', x.end)"
    kept = f"x.late = 1 and x.end > a.state.base and x.end > {reach}"
    step = (
        f"named_struct('state', if(x.late = 0, {after_base}, {after_random}),"
        f" 'out', if({kept}, array({span}), cast(array() as {SPANS})))"
    )
    state = "named_struct('base', 0, 'reach', 0, 'start', -1, 'end', -1)"
    return f"if(size({random}) = 0, {random}, {scanned(ordered, state, step, SPANS)})"


def redacted(docs: DataFrame, text: str = "text", mask: str = "[secret]") -> DataFrame:
    """The documents with every secret of their text replaced by ``mask``; others stay unchanged.

    Overlapping spans become one. A null text stays null.
    """
    spans, gaps, body = fresh(docs, "secret spans", "secret gaps", "secret text")
    # What is kept before each group of overlapping or touching spans, and behind the last.
    step = (
        "named_struct('state', named_struct('end', greatest(a.state.end, x.end), 'any', true), 'out',"
        " if(a.state.any and x.start <= a.state.end, cast(array() as array<struct<start:int,end:int>>),"
        " array(named_struct('start', a.state.end, 'end', x.start))))"
    )
    state = "named_struct('end', 0, 'any', false)"
    between = scanned(f"`{spans}`", state, step, "array<struct<start:int,end:int>>")
    last = f"named_struct('start', array_max(transform(`{spans}`, s -> s.end)), 'end', length(`{body}`))"
    first = f"greatest(g.start - c * {CHUNK}, 0)"
    chunk = f"substring(get(cs, c), {first} + 1, least(g.end - c * {CHUNK}, {CHUNK}) - {first})"
    part = f"array_join(transform(sequence(g.start div {CHUNK}, (g.end - 1) div {CHUNK}), c -> {chunk}), '')"
    kept = bound(
        f"regexp_extract_all(`{body}`, '(?s).{{1,{CHUNK}}}', 0)",
        "cs",
        f"array_join(transform(`{gaps}`, g -> if(g.start >= g.end, '', {part})), {literal(mask)})",
    )
    # The text under a name that no variable of the expressions has.
    found = secret_spans(docs.withColumn(body, F.col(quoted(text))), body, name=spans)
    cleaned = F.expr(f"if(size(`{spans}`) > 0, {kept}, `{body}`)")
    cut = found.withColumn(gaps, F.expr(f"if(size(`{spans}`) > 0, {between} || array({last}), null)"))
    return cut.withColumn(text, cleaned).drop(spans, gaps, body)


def joined(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined in their order."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def secret_report(docs: DataFrame, patterns: Sequence[Pattern] = BASE) -> DataFrame:
    """Per document the number of spans of each base kind, a hash of those, and all spans as text."""
    found = secret_spans(docs.select("doc_id", "text"), patterns=patterns)
    base = F.filter("secrets", lambda s: s["place"] < len(patterns))
    counts = [
        F.expr(f"cast(size(filter(secrets, s -> s.kind = '{p.kind}')) as bigint) as n_{p.kind}")
        for p in patterns
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("secrets")).alias("spans"),
    )
