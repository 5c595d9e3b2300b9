"""Secret scans: base patterns, and assignment-aware lexing.

Base spans are those of three fixed patterns, leftmost and non-overlapping
per kind, dropped (not retried) when too short.  The method reads source and
configuration syntax into (name, value) pairs.  A target may be quoted,
subscripted (``config["NAME"]`` goes by its last subscript) or annotated with
a type; setters (``setName("...")``), two-argument lookups and puts
(``getenv("NAME", "...")``) and elements (``<name>...</name>``) are assignments
too.  A value is a quoted literal with its prefixes and escapes, in one or three
quotes, joined ones, also in brackets over lines; an indented block of one word; a
bare word; or a reference such as ``NAME``, ``$NAME``, ``${NAME}`` or
``os.environ["NAME"]``, maybe with a literal where it has no value.  All pairs of a text are read
first; then each name hands its score on to what its value refers to, above or
below, through any number of references.  A bare word refers to the last
assignment above, or else to all below; the other references have no order
and mean every assignment of their name.  A bare word that leads to no literal
is one; any other reference never is.  A literal's score is that of the most
sensitive name that reaches it, times how much it looks like a key; spans of
kind ``named`` cover literals that reach the bound.

Defined results: null text counts as empty, with no spans.  Positions are
code points, ends exclusive.  Repeated rows give repeated results.  Other
columns are ignored by :func:`scan` and kept by :func:`redact`.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import batch_of, chunks, register, rows_in, table, text_or_empty

# The base patterns.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # the same as [0-9a-f]+ of 24 or more: runs are taken whole
KINDS = ("assign", "access", "hex", "named")

#: How sensitive parts of a target name are; pairs stand for adjacent parts.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "secret": 1.0, "token": 0.9, "apikey": 1.0, "credential": 0.9,
    "credentials": 0.9, "bearer": 0.8, "api key": 1.0, "access key": 1.0, "private key": 1.0, "secret key": 1.0,
    "signing key": 0.9, "encryption key": 0.9, "client secret": 1.0, "auth key": 0.9, "auth": 0.6, "key": 0.4,
}
BOUND = 0.5
#: A quoted literal: prefixes, escapes, three quotes over lines, back quotes.
STRING = re.compile(
    r'''[rRbBfFuU]{0,2}(?:"""(?:[^"\\]|\\[\s\S]|"(?!""))*+"""|\'\'\'(?:[^'\\]|\\[\s\S]|'(?!\'\'))*+\'\'\''''
    r'''|"(?:[^"\\\n]|\\.)*+"|'(?:[^'\\\n]|\\.)*+'|`[^`\n]*+`)'''
)
QUOTE = re.compile(r'''[rRbBfFuU]{0,2}("""|\'\'\'|["'`])''')
#: A target: a name, maybe quoted, subscripted or annotated with a type, and what assigns to it.
HEAD = re.compile(
    r"""(?<![\w.$-])["']?(?P<name>[A-Za-z_][\w.-]*+(?:\[[ \t]*(?:"[^"\n]*+"|'[^'\n]*+'|[\w.]++)[ \t]*\])*+)["']?[ \t]*+"""
    r"""(?:(?P<type>:[ \t]*+[A-Za-z_][\w.]*+(?:\[(?:[^\[\]\n"'=]|\[[^\[\]\n"'=]*+\])*+\]|<(?:[^<>\n"'=]|<[^<>\n"'=]*+>)*+>)?+(?:[ \t]*+\|[ \t]*+[A-Za-z_][\w.]*+)*+\??(?:[ \t]++=[ \t]*+(?=[\w"'`(])|=(?=["'`])))"""
    r"""|(?::=|=>|==|!=|[:=])[ \t]*+)"""
)
#: A value that is no quoted literal: a reference or a bare word.
VALUE = re.compile(r"""\$\{[A-Za-z_][\w.-]*\}|[\w.]+(?:[\[(]["'][A-Za-z_][\w.-]*["'][\])]?)+|[^\s"',;#\])}]+""")
#: A call that is no reference, up to where a bare word ends.
CALLED = re.compile(r"[A-Za-z_][\w.]*+\(")
OPEN = re.compile(r"\([ \t\r\n]*+")
GOES_ON, GOES_ON_WRAPPED = re.compile(r"[ \t]*+\+[ \t]*+"), re.compile(r"[ \t\r\n]*+\+?[ \t\r\n]*+")
CONTINUED = re.compile(r"\\\r?\n[ \t]*+")
#: An indented block of one word, as configuration files have it.
BLOCK = re.compile(r"[|>][+-]?[ \t]*+\r?\n[ \t]++([^\s#]++)[ \t]*+(?=\r?\n|$)")
#: What gives a value where a reference has none.
ELSE = re.compile(r"[ \t]*+(?:\|\||\?\?|or(?=[ \t]))[ \t]*+")
#: Calls with one or two quoted arguments: setters by their own name, lookups and puts by the first argument.
CALL = re.compile(rf"(?<![\w.$])(?P<callee>[A-Za-z_][\w.]*+)\([ \t]*+(?P<a>{STRING.pattern})[ \t]*+(?:,[ \t]*+(?P<b>{STRING.pattern})[ \t]*+)?\)")
PUTS, SETS = re.compile(r"(?i:get|set|put|add|with|define|env)"), re.compile(r"(?i:set|with|add|put|use)(?=[_A-Z])")
ELEMENT = re.compile(r"<(?P<name>[A-Za-z_][\w.:-]*+)(?:[ \t][^<>\n]*+)?>[ \t\r\n]*+(?P<v>[^<>\s]++)[ \t\r\n]*+</")
PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
REFERENCE = re.compile(
    r"""\$\{([A-Za-z_][\w.-]*)\}|\$([A-Za-z_]\w*)|[\w.]+(?:[\[(]["'][A-Za-z_][\w.-]*["'][\])]?)*[\[(]["']([A-Za-z_][\w.-]*)["'][\])]?|(?P<bare>[A-Za-z_][\w.]*)"""
)
#: The last subscript of a target, by which references name it.
SUBSCRIPT = re.compile(r"""\[[ \t]*["']?([^\[\]"']*?)["']?[ \t]*\]$""")
PLACEHOLDER = re.compile(r"(?i)(?:x+|\*+|\.+|-+|<.*>|\{.*\}|change_?me|example|none|null|true|false|your.*|test|todo)")


def name_score(name: str) -> float:
    parts = [p.lower() for p in PART.findall(name)]
    return max([0.0, *(SENSITIVE.get(p, 0.0) for p in parts), *(SENSITIVE.get(f"{a} {b}", 0.0) for a, b in zip(parts, parts[1:]))])


def literal_score(value: str) -> float:
    """0 to 1: long, varied literals that are no words or placeholders."""
    if len(value) < 6 or PLACEHOLDER.fullmatch(value) or any(c.isspace() for c in value):
        return 0.0
    n = len(value)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    classes = sum(bool(re.search(p, value)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    return min(1.0, entropy / 3.0) * (0.5 if classes < 2 else 0.8 if n < 8 else 1.0)


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, start of the secret itself)."""
    out = []
    if "=" in text or ":" in text:
        out += [(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(text) if m.end() - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(out)


Pair = tuple[str, list[tuple[int, int]], str | None, bool]


def inside(text: str, start: int, end: int) -> tuple[int, int]:
    """The span of a quoted literal's text; of one in three quotes without the white space at its ends."""
    quote = QUOTE.match(text, start)
    a, b = quote.end(), end - len(quote[1])
    if len(quote[1]) == 3:
        own = text[a:b]
        a, b = a + len(own) - len(own.lstrip()), b - len(own) + len(own.rstrip())
    return a, max(a, b)


def literal_at(text: str, at: int, wrapped: bool) -> tuple[list[tuple[int, int]], int]:
    """The spans of the quoted literals from ``at`` on that make one value, and where they end."""
    spans, end = [], at
    found = STRING.match(text, at)
    while found:
        spans.append(inside(text, found.start(), found.end()))
        end = found.end()
        found = STRING.match(text, (go.end() if (go := (GOES_ON_WRAPPED if wrapped else GOES_ON).match(text, end)) else end))
        if found and not wrapped and found.start() == end:
            break  # two literals side by side are two values, but in brackets
    return spans, end


def value_at(text: str, at: int) -> tuple[list[tuple[list[tuple[int, int]], str | None, bool]], int]:
    """The values assigned at ``at`` (spans, reference, whether it is a bare word) and where they end."""
    if line := CONTINUED.match(text, at):
        at = line.end()
    if block := BLOCK.match(text, at):
        return [([block.span(1)], None, False)], block.end()
    wrapped = OPEN.match(text, at)
    spans, end = literal_at(text, wrapped.end() if wrapped else at, bool(wrapped))
    if spans:
        return [(spans, None, False)], end
    word = VALUE.match(text, at)
    if wrapped or word is None or word[0][0] in "[{":
        return [], at
    ref = REFERENCE.fullmatch(word[0])
    if ref is None and CALLED.match(word[0]) and text[word.end() : word.end() + 1] in (")", ",", '"', "'"):
        return [], word.end()
    name = next(filter(None, ref.groups()), None) if ref else None
    other = ELSE.match(text, word.end()) if ref else None
    spans, end = literal_at(text, other.end(), False) if other else ([], 0)
    if spans:
        return [([word.span()], name, False), (spans, None, False)], end
    return [([word.span()], name, bool(ref and ref["bare"]))], word.end()


def pairs(text: str) -> list[Pair]:
    """(target, spans of the literal's text, name referred to, whether that is a bare word) of every assignment, in order."""
    found: list[tuple[int, Pair]] = []
    at = 0
    while head := HEAD.search(text, at):
        values, at = value_at(text, head.end())
        found += [(head.start(), (head["name"], *value)) for value in values]
    if "(" in text:
        for call in CALL.finditer(text):
            name = call["callee"].rpartition(".")[2]
            if call["b"] and PUTS.match(name):
                a, b = inside(text, *call.span("a"))
                found.append((call.start(), (text[a:b], [inside(text, *call.span("b"))], None, False)))
            elif not call["b"] and SETS.match(name):
                found.append((call.start(), (name, [inside(text, *call.span("a"))], None, False)))
    if "</" in text:
        found += [(m.start(), (m["name"], [m.span("v")], None, False)) for m in ELEMENT.finditer(text)]
    return [pair for _, pair in sorted(found, key=lambda x: x[0])]


def named_spans(text: str) -> list[tuple[int, int, int, int]]:
    if not any(sign in text for sign in "=:(<"):
        return []
    found = pairs(text)
    assigned: dict[str, list[int]] = {}  # name -> its assignments in order
    keys = []
    for i, (target, _, _, _) in enumerate(found):
        inner = SUBSCRIPT.search(target)
        keys.append(inner[1] if inner else target)
        assigned.setdefault(keys[-1], []).append(i)

    # What each reference is to: one assignment (bare words: the last above), or all of a name.
    one: dict[int, int] = {}
    every: dict[int, str] = {}
    for i, (_, _, reference, bare) in enumerate(found):
        places = assigned.get(reference, []) if reference else []
        above = bisect_left(places, i) if bare else 0
        if above:
            one[i] = places[above - 1]
        elif places and places != [i]:
            every[i] = reference
    waiting: dict[int | str, list[int]] = {}
    for i, to in [*one.items(), *every.items()]:
        waiting.setdefault(to, []).append(i)

    # Assignments whose value ends in a literal; bare words that lead to none are literals themselves.
    literal = {i for i, (_, _, reference, bare) in enumerate(found) if reference is None or (bare and i not in one and i not in every)}
    ends, queue = set(literal), list(literal)
    while queue:
        j = queue.pop()
        for i in (*waiting.pop(j, ()), *waiting.pop(keys[j], ())):
            if i not in ends:
                ends.add(i)
                queue.append(i)
    literal |= {i for i, x in enumerate(found) if x[3] and i not in ends}

    # The most sensitive names first hand their score on to all that they refer to.
    scores = [name_score(target) for target, _, _, _ in found]
    best: dict[int, float] = {}
    handed: set[str] = set()
    for start in sorted((i for i, s in enumerate(scores) if s), key=lambda i: -scores[i]):
        queue = [start]
        while queue:
            i = queue.pop()
            if i in best:
                continue
            best[i] = scores[start]
            if i in literal:
                continue
            if i in one:
                queue.append(one[i])
            elif i in every and every[i] not in handed:
                handed.add(every[i])
                queue += assigned[every[i]]
    out = []
    for i in literal & best.keys():
        spans = found[i][1]
        if best[i] * literal_score("".join(text[a:b] for a, b in spans)) >= BOUND:
            out += [(a, 3, b, a) for a, b in spans if b > a]
    return out


def all_spans(text: str) -> tuple[list, list]:
    base = base_spans(text)
    return base, sorted({*base, *named_spans(text)})


def joined(spans: list) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b, _ in spans)


def redacted(text: str, mark: str = "<SECRET>") -> str:
    """The text with every secret replaced; names of assignments stay."""
    out, at = [], 0
    for a, b in sorted((x[3], x[2]) for x in all_spans(text)[1]):
        if b > at:
            out += [text[at : max(a, at)], mark if a >= at else ""]
            at = b
    return "".join(out) + text[at:] if out else text


SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()),
                    ("base_sha256", pa.string()), ("spans", pa.string())])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in chunks(rows_in(batches), lambda r: len(r[1])):
        out = []
        for doc_id, text in rows:
            base, every = all_spans(text)
            n = Counter(k for _, k, _, _ in base)
            out.append((doc_id, n[0], n[1], n[2], hashlib.sha256(joined(base).encode()).hexdigest(), joined(every)))
        yield batch_of(SCHEMA, list(zip(*out)))


def scan(docs: DataFrame) -> DataFrame:
    """Spans of secrets in every document."""
    return docs.select("doc_id", text_or_empty("text").alias("text")).mapInArrow(
        _scan, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    )


def redact(docs: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """All rows and columns, secrets replaced in the text and its length brought up to date; null text stays null."""

    @F.pandas_udf("string")
    def clean(texts):
        return texts.map(lambda t: None if t is None else redacted(t))

    out = docs.withColumn(text, clean(F.col(text)))
    if length in docs.columns:
        out = out.withColumn(length, F.when(F.col(text).isNull(), F.col(length)).otherwise(F.char_length(text)).cast(docs.schema[length].dataType))
    return out.select(*docs.columns)


@register("op8_secrets")
def op8(spark, sf_dir):
    return scan(table(spark, sf_dir, "documents"))
