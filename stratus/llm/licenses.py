"""Operator 4: licence scan with an Aho-Corasick automaton and a licence-expression parser.

One automaton holds notice phrases and the marker of identifier tags.  It runs
over the text's words, joined by single blanks, so a phrase matches where its
words stand consecutively.  An identifier tag's expression is read from the
text, turned into postfix order by a shunting-yard parser (``with`` binds
tighter than ``and``, ``and`` tighter than ``or``, brackets) and evaluated: the
permissiveness of ``A and B`` is the smaller, of ``A or B`` the larger, and an
exception (``A with X``) takes away half of what ``A`` lacks.  A document's score
is the smallest permissiveness of all its notices and tags: 1 where nothing
restricts it, 0 where all rights are reserved.  A notice that lies inside a longer
one (the general licence's name inside the lesser one's) keeps its place and label
but does not enter the score, nor does the notice of a licence that a tag's
expression names: the expression says what it is worth there.

Scale: one pass, row by row, no shuffle; the automaton is a constant.

Defined results: a NULL text is empty (no words, score 1); a tag whose
expression does not parse gives the labels of the identifiers in it and the
smallest of their values; unknown identifiers count 0.5; repeated rows give
repeated results; extra columns are ignored.
"""

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, small_batches, table, text_or_empty, worker_object

ship(__name__)

#: The base phrases (fixed values).
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Further notices (fixed values).
NOTICES = {
    "apache license": "apache", "mit license": "mit", "bsd license": "bsd", "isc license": "isc",
    "mozilla public license": "mpl", "lesser general public license": "lgpl", "affero general public license": "agpl",
    "eclipse public license": "epl", "public domain": "public-domain", "cc0": "cc0", "unlicense": "unlicense",
    "cc by nc": "cc-by-nc", "cc by nd": "cc-by-nd", "cc by sa": "cc-by-sa", "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd", "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd", "boost software license": "bsl",
    "do not distribute": "proprietary", "confidential and proprietary": "proprietary",
}
#: Permissiveness of labels and of the first part of identifiers (fixed values).
VALUE = {
    "reserved": 0.0, "proprietary": 0.0, "agpl": 0.2, "gpl": 0.3, "cc-by-nc-nd": 0.2, "cc-by-nc": 0.3, "cc-by-nc-sa": 0.3,
    "cc-by-nd": 0.3, "lgpl": 0.5, "mpl": 0.6, "epl": 0.6, "cc-by-sa": 0.6, "cc-by": 0.9, "apache": 1.0, "mit": 1.0,
    "bsd": 1.0, "isc": 1.0, "bsl": 1.0, "cc0": 1.0, "unlicense": 1.0, "public-domain": 1.0, "zlib": 1.0,
}
UNKNOWN = 0.5
TAG = " spdx license identifier "
TAG_TEXT = re.compile(r"spdx-license-identifier\s*:\s*([^\n]*)", re.IGNORECASE | re.ASCII)
ITEM = re.compile(r"[()]|[A-Za-z0-9][A-Za-z0-9.+\-]*", re.ASCII)
PRECEDENCE = {"or": 1, "and": 2, "with": 3}

#: A-Z to lower case; every other ASCII byte but 0-9 and a-z to a blank; bytes of other characters stay.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def automaton():
    import ahocorasick

    auto = ahocorasick.Automaton()
    for phrase, label in {**NOTICES, **BASE}.items():
        auto.add_word(f" {phrase} ", (phrase, label))
    auto.add_word(TAG, (TAG.strip(), None))
    auto.make_automaton()
    return auto


def identifier_label(name: str) -> str:
    """Label of an identifier: its longest known leading part, else the whole, in lower case."""
    parts = name.lower().rstrip("+").split("-")
    for n in range(len(parts), 0, -1):
        if "-".join(parts[:n]) in VALUE:
            return "-".join(parts[:n])
    return "-".join(parts)


def parse_expression(text: str) -> tuple[list[str], list[str]]:
    """(postfix items, identifiers) of a licence expression; reads as far as it is one.

    Raises ``ValueError`` with the identifiers found when brackets or operands do not match.
    """
    out, stack, names, expect = [], [], [], True
    for item in ITEM.findall(text):
        low = item.lower()
        if low in PRECEDENCE:
            if expect:
                raise ValueError(names)
            while stack and stack[-1] != "(" and PRECEDENCE[stack[-1]] >= PRECEDENCE[low]:
                out.append(stack.pop())
            stack.append(low)
            expect = True
        elif item == "(":
            if not expect:
                break
            stack.append(item)
        elif item == ")":
            if expect:
                raise ValueError(names)
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                break
            stack.pop()
        elif expect:
            if not (stack and stack[-1] == "with"):
                names.append(item)
            out.append(item)
            expect = False
        else:
            break  # the expression is over; prose follows
    if expect or "(" in stack:
        raise ValueError(names)
    return out + stack[::-1], names


def evaluate(postfix: list[str]) -> float:
    stack: list = []
    for item in postfix:
        if item not in PRECEDENCE:
            stack.append((VALUE.get(identifier_label(item), UNKNOWN), item))
            continue
        (right, _), (left, name) = stack.pop(), stack.pop()
        if item == "with":
            stack.append((left + (1 - left) / 2, name))
        else:
            stack.append(((min if item == "and" else max)(left, right), name))
    return stack[0][0]


def tag_results(text: str) -> tuple[set[str], list[float]]:
    labels, values = set(), []
    for m in TAG_TEXT.finditer(text):
        try:
            postfix, names = parse_expression(m.group(1))
            values.append(evaluate(postfix))
        except ValueError as e:
            names = e.args[0]
            values += [VALUE.get(identifier_label(n), UNKNOWN) for n in names]
        labels.update(identifier_label(n) for n in names)
    return labels, values


def scan_text(text: str) -> dict:
    words = text.encode().translate(_FOLD).split()
    line = b" " + b" ".join(words) + b" "
    auto = worker_object("licence-automaton", automaton)
    n_base, places, base, found, tagged = 0, [], set(), [], False
    line = line.decode("latin-1")  # a character per byte; the phrases are ASCII
    for end, (phrase, label) in auto.iter(line):
        if label is None:
            tagged = True
            continue
        found.append((end - len(phrase) - 1, end, label))
        if phrase in BASE:
            n_base += 1
            places.append(end - len(phrase) - 1)
            base.add(label)
    tags, values = tag_results(text) if tagged else (set(), [])
    last = -1
    for _, end, label in sorted(found, key=lambda f: (f[0], -f[1])):
        if end > last and label not in tags:  # not inside a notice that began before
            values.append(VALUE[label])
        last = max(last, end)
    labels = tags | {label for *_, label in found}
    word = lambda at: line.count(" ", 0, at + 1) - 1
    return {"n_words": len(words), "n_base": n_base, "first_word": word(min(places)) if places else None,
            "last_word": word(max(places)) if places else None, "base_labels": sorted(base), "labels": sorted(labels),
            "score": min(values, default=1.0)}


def licence_column(text: Column) -> Column:
    @F.pandas_udf("array<struct<n_words:long,n_base:long,first_word:long,last_word:long,base_labels:array<string>,"
                  "labels:array<string>,score:double>>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([[scan_text(t)] for t in texts], dtype=object)

    return F.element_at(run(text), 1)


def scan(docs: DataFrame, text_col: str = "text", name: str = "licence") -> DataFrame:
    """``docs`` with a struct of word count, base places, labels and score."""
    return small_batches(docs).withColumn(name, licence_column(text_or_empty(text_col)))


def op4_license_scans(spark, sf_dir):
    docs = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    c = F.col("licence")
    return docs.select("doc_id", c["n_words"].alias("n_words"), c["n_base"].alias("n_base"), c["first_word"].alias("first_word"),
                       c["last_word"].alias("last_word"), F.array_join(c["base_labels"], ",").alias("base_labels"),
                       F.array_join(c["labels"], ",").alias("labels"), c["score"].alias("score"))
