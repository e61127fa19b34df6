"""Operator 6: secret scan by assignment-aware lexing.

Three fixed patterns find assignments to well-known names, access keys and
hex strings.  Beside them a lexer reads source and configuration syntax as a
stream of names, operators and literals and builds name-literal pairs:
``name = "literal"``, ``name: literal``, ``"name": "literal"``,
``name => literal``, ``box["name"] = literal``, ``name[] = {"literal", ...}``,
``--name literal``, ``setenv name literal``, ``<name>literal</name>`` and the
lines of a block ``name: |``.  Names bound to a literal are
constants; a later ``other = NAME`` passes the literal on to ``other``, and a
concatenation (``A + "x"``, adjacent strings) joins its parts, each literal
once.  A constant is kept as the positions of its own literals and references
to the constants it was joined from, whatever their number, so a chain of sums
takes memory in proportion to its length; literals are gathered only for
targets whose name is sensitive.  A pair's score is the sensitivity of its
target name times how much its literal looks like a credential; the literals
of pairs at or above the threshold are spans of kind ``literal``.

Scale: one pass, row by row, no shuffle.  A text without any assignment
operator or flag is not lexed.

Defined results: a NULL text is empty and has no spans; a very long text is
read whole; repeated rows give repeated results; extra columns are ignored.
Offsets are code points, ends exclusive.
"""

import hashlib
import math
import re
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, small_batches, table, text_or_empty

ship(__name__)

KINDS = ("assign", "access", "hex", "literal")
#: The base patterns (fixed values): kind, pattern, group whose length counts, shortest length.
BASE = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                          re.IGNORECASE | re.ASCII), 2, 8),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 32),
)
#: Hex runs of the least length; shorter ones would be dropped anyway.
_HEX32 = re.compile(r"[0-9a-f]{32,}")

#: Sensitivity of the parts of a name (fixed values).
SENSITIVE = {"password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "pass": 0.8, "secret": 1.0, "token": 0.9,
             "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "cred": 0.8, "auth": 0.6, "bearer": 0.8, "key": 0.5,
             "private": 0.4, "access": 0.3, "signing": 0.4, "encryption": 0.4, "api": 0.4, "client": 0.2, "salt": 0.5}
#: Words that mark a literal as no credential (fixed values).
PLACEHOLDER = re.compile(r"example|sample|changeme|change_me|placeholder|your[_-]?|xxxx|\*\*\*|dummy|<[^>]*>|\$\{|\{\{|^(?:none|null|true|false|todo|test)$",
                         re.IGNORECASE)
THRESHOLD = 0.45

NAME = r"[A-Za-z_][A-Za-z0-9_.\-]*"
#: One token of the lexer, in order of preference.
TOKEN = re.compile(r"""
    (?P<comment>(?:\#|//)[^\n]*)
  | (?P<string>"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|`[^`\n]*`)
  | (?P<op>:=|=>|==|!=|<=|>=|[=:+,;{}()\[\]<>])
  | (?P<word>[^\s"'`=:+,;{}()\[\]<>\#]+)
  | (?P<eol>\n)
""", re.VERBOSE)
#: Where an assignment may begin: a name, perhaps quoted, before an operator.
TARGET = re.compile(rf"""(?P<q>["'])?(?<![A-Za-z0-9_.])(?P<name>{NAME})(?(q)(?P=q)\]?)(?:\[[0-9]*\])?[\x20\t]*(?P<op>:=|=>|=(?!=)|:(?![:/]))[\x20\t]*""", re.ASCII)
REFERENCE = re.compile(r"[A-Za-z_]\w*(?:\.[A-Za-z_]\w*)+")
#: Least length of a dotted word's part that can be a credential, and the mean length of the words in a name.
LEAST_PART, WORD_LENGTH = 10, 3
#: Pairs without an operator: command-line flags, ``setenv``, elements of one literal, indented block values.
PLAIN = (
    re.compile(r"(?<![\w-])--(?P<name>[a-z][a-z0-9-]*)[\x20=](?P<value>[^\s\"'`]+)", re.ASCII),
    re.compile(rf"(?m)^[\x20\t]*setenv[\x20\t]+(?P<name>{NAME})[\x20\t]+[\"']?(?P<value>[^\s\"']+)", re.ASCII),
    re.compile(rf"<(?P<name>{NAME})>\s*(?P<value>[^\s<>]+)\s*</(?P=name)>", re.ASCII),
    re.compile(rf"(?m)^[\x20\t-]*[\"']?(?P<name>{NAME})[\"']?:[\x20\t]+[|>][+-]?[\x20\t]*\n(?P<value>(?:[\x20\t]+\S[^\n]*(?:\n|\Z))+)", re.ASCII),
)
#: The rest of an unquoted value that holds colons (no scheme of an address).
COLONS = re.compile(r"(?::[^\s\"'`=:+,;{}()\[\]<>\#/][^\s\"'`=:+,;{}()\[\]<>\#]*)+")
OPEN, AFTER_KEY = re.compile(r"[\[({]\s*(?=[\"'`])"), re.compile(r"[\x20\t]*(?:=>|[:=])")
PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
#: Every pair has one of these.
MAYBE = re.compile(r"[=:]|--|setenv|</")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = []
    for kind, pattern, group, least in BASE:
        if kind == "access" and "AKIA" not in text:
            continue
        for m in (_HEX32 if kind == "hex" else pattern).finditer(text):
            if m.end(group) - m.start(group) >= least:
                out.append((kind, m.start(), m.end()))
    return out


def name_score(name: str) -> float:
    """How sensitive a target name is, 0 to 1: the sum over its camel, snake or dotted parts, at most 1."""
    parts = [p.lower() for p in PART.findall(name)]
    whole = "".join(parts)
    score = sum(SENSITIVE.get(p, 0.0) for p in parts)
    if whole in SENSITIVE:
        score = max(score, SENSITIVE[whole])
    if parts and parts[-1] in ("id", "name", "url", "path", "file", "length", "size", "count", "type", "field"):
        score *= 0.3
    return min(1.0, score)


def literal_score(value: str) -> float:
    """How much a literal looks like a credential, 0 to 1: length, mixed classes and entropy."""
    n = len(value)
    if n < 6 or PLACEHOLDER.search(value) or any(c.isspace() for c in value):
        return 0.0
    counts = Counter(value).values()
    entropy = -sum(c / n * math.log2(c / n) for c in counts)
    classes = sum(bool(re.search(p, value)) for p in ("[a-z]", "[A-Z]", "[0-9]", r"[^A-Za-z0-9]"))
    return min(1.0, entropy / 3.5) * (1.0 if classes >= 2 else 0.5)


def _random(part: str) -> bool:
    """Whether a dotted word's part is letters and digits mixed at random rather than a name made of words."""
    pieces = PART.findall(part)
    mixed = sum(bool(re.search(p, part)) for p in ("[a-z]", "[A-Z]", "[0-9]")) >= 2
    return len(part) >= LEAST_PART and mixed and sum(map(len, pieces)) < WORD_LENGTH * len(pieces)


def is_reference(word: str, constants: dict) -> bool:
    """Whether an unquoted dotted word names an attribute: its head is bound, or no part looks like a credential."""
    if not REFERENCE.fullmatch(word):
        return False
    parts = word.split(".")
    return parts[0] in constants or not any(map(_random, parts))


def _value(text: str, at: int, constants: dict) -> list:
    """The right-hand side that begins at ``at``: spans of literals, and the lists of the constants joined in."""
    opened = OPEN.match(text, at)
    items, joined = [], True
    for m in TOKEN.finditer(text, opened.end() if opened else at):
        kind, got = m.lastgroup, m.group()
        if kind == "string":
            if opened and AFTER_KEY.match(text, m.end()):
                break  # a key of a nested mapping, itself a target
            items.append((m.start() + 1, m.end() - 1))
            joined = False
        elif kind == "op" and got == "+" and items:
            joined = True
        elif opened and (kind == "eol" or got == ","):
            continue
        elif kind == "word" and joined:
            end = m.end()
            if got in constants:
                items.append(constants[got])
            elif not items and is_reference(got, constants) or text[end:end + 1] in ("(", "["):
                break  # an attribute, a call or an element: no literal
            elif not items:
                more = COLONS.match(text, end)
                end = more.end() if more else end
                items.append((m.start(), end - (len(text[m.start():end]) - len(text[m.start():end].rstrip(".,")))))
                if more:
                    break
            joined = False
            if text[end:end + 1] in (":", "/") and len(items) == 1:
                break
        else:
            break
    return items


def literals_of(items: list) -> list[tuple[int, int]]:
    """Spans of the literals that a value was joined from, in order, each once."""
    spans, seen, stack = {}, set(), [iter(items)]
    while stack:
        item = next(stack[-1], None)
        if item is None:
            stack.pop()
        elif isinstance(item, tuple):
            spans[item] = None
        elif id(item) not in seen:
            seen.add(id(item))
            stack.append(iter(item))
    return list(spans)


def name_literal_pairs(text: str, wanted=lambda name: True):
    """(name, spans of the literal's parts, value) of the wanted names, in order; constants are passed on."""
    constants: dict = {}
    for m in TARGET.finditer(text):
        items = _value(text, m.end(), constants)
        if not items:
            continue
        name = m.group("name")
        constants[name] = constants[name.rpartition(".")[2]] = items
        if wanted(name):
            spans = literals_of(items)
            yield name, spans, "".join(text[a:b] for a, b in spans)
    for pattern in PLAIN:
        for m in pattern.finditer(text):
            if wanted(m.group("name")):
                spans = [(m.start("value") + w.start(), m.start("value") + w.end()) for w in re.finditer(r"\S+", m.group("value"))]
                yield m.group("name"), spans, "".join(text[a:b] for a, b in spans)


def literal_spans(text: str, threshold: float = THRESHOLD) -> list[tuple[str, int, int]]:
    if not MAYBE.search(text):
        return []
    found = set()
    for name, spans, value in name_literal_pairs(text, lambda name: name_score(name) >= threshold):
        if name_score(name) * literal_score(value) >= threshold:
            found.update(("literal", a, b) for a, b in spans if b > a)
    return sorted(found)


def all_spans(text: str) -> list[tuple[str, int, int]]:
    order = {k: i for i, k in enumerate(KINDS)}
    return sorted(base_spans(text) + literal_spans(text), key=lambda s: (s[1], order[s[0]], s[2]))


def redact(text: str, spans: list[tuple[str, int, int]], mark: str = "<SECRET>") -> str:
    """``text`` with every stretch covered by spans replaced by ``mark``."""
    out, at, end = [], 0, -1
    for _, a, b in sorted(spans, key=lambda s: (s[1], s[2])):
        if a > end:
            if end >= 0:
                out.append(mark)
                at = end
            out.append(text[at:a])
        end = max(end, b)
    if end >= 0:
        out.append(mark)
        at = end
    return "".join(out) + text[at:]


def spans_column(text: Column) -> Column:
    @F.pandas_udf("array<struct<kind:string,start:int,end:int>>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"kind": k, "start": a, "end": b} for k, a, b in all_spans(t)] for t in texts], dtype=object)

    return run(text)


def scan(docs: DataFrame, text_col: str = "text", name: str = "spans") -> DataFrame:
    """``docs`` with the array of spans (kind, start, end) of each text."""
    return small_batches(docs).withColumn(name, spans_column(text_or_empty(text_col)))


def redacted(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every secret in ``text_col`` replaced by a mark; texts without one are unchanged."""
    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([t if t is None or not (s := all_spans(t)) else redact(t, s) for t in texts], dtype=object)

    return small_batches(docs).withColumn(text_col, run(F.col(text_col)))


def op6_secret_scans(spark, sf_dir):
    docs = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base = F.filter("spans", lambda s: s["kind"] != "literal")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return docs.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
                       F.sha2(F.array_join(F.transform(base, one), ","), 256).alias("base_sha256"),
                       F.array_join(F.transform("spans", one), ",").alias("spans"))
