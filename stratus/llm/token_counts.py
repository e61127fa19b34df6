"""Operator 7: greedy word-piece token counts by a linear longest-match automaton.

The vocabulary is a trie over bytes; an entry that ends a word ends with an
extra symbol.  A trie node that is no entry has a failure link: the pieces
that greedy longest matching would take off its string, and the node of what
is left.  Only the *number* of those pieces is kept, so a word's token count is
read off in one pass over its bytes, with no pieces built and no step back.

Scale: one pass, row by row, no shuffle.  The automaton is built once in a
worker; counts of words seen are kept in a cache of bounded size.

Defined results: a NULL text is empty and counts 0; a word that no sequence of
entries spells counts as one (unknown) token; repeated rows give repeated
results; an empty table gives no rows; extra columns are ignored.
"""

import json
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import TOKENIZERS, ship, small_batches, table, text_or_empty, vocabulary, worker_object

ship(__name__)

WORD_END = 256
SUFFIX = "</w>"
CACHE_WORDS = 200_000
#: The vocabulary's own split into words (fixed value).
WORD = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1
    characters for themselves, the other bytes, in order, for the characters from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def entries(path: str) -> list[tuple[int, ...]]:
    """The vocabulary as symbol sequences: bytes, and WORD_END where an entry ends a word."""
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    to_byte = byte_of()
    out = []
    for token in vocab:
        body = token[:-len(SUFFIX)] if token.endswith(SUFFIX) else token
        if body and all(c in to_byte for c in body):
            out.append(tuple(to_byte[c] for c in body) + ((WORD_END,) if body != token else ()))
    return out


class Automaton:
    """Trie with failure links and popped-piece counts."""

    def __init__(self, tokens):
        step: list[dict[int, int]] = [{}]
        is_token = [False]
        for token in tokens:
            at = 0
            for s in token:
                if s not in step[at]:
                    step[at][s] = len(step)
                    step.append({})
                    is_token.append(False)
                at = step[at][s]
            is_token[at] = True
        self.step, self.fail, self.pops = step, [-1] * len(step), [0] * len(step)
        level = [0]
        while level:  # breadth first: a node's link needs its parent's
            below = []
            for u in level:
                for s, v in step[u].items():
                    below.append(v)
                    if is_token[v]:
                        self.fail[v], self.pops[v] = 0, 1
                        continue
                    z, n = self.fail[u], self.pops[u]
                    while z >= 0 and s not in step[z]:
                        n += self.pops[z]
                        z = self.fail[z]
                    if z >= 0:
                        self.fail[v], self.pops[v] = step[z][s], n
            level = below

    def count(self, word: bytes) -> int:
        step, fail, pops, u, n = self.step, self.fail, self.pops, 0, 0
        for s in (*word, WORD_END):
            while s not in step[u]:
                if fail[u] < 0:
                    return 1
                n += pops[u]
                u = fail[u]
            u = step[u][s]
        while u:
            if fail[u] < 0:
                return 1
            n += pops[u]
            u = fail[u]
        return n


class Counts(dict):
    """Token counts of words, computed when first seen; emptied when full."""

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        n = self[word] = self.automaton.count(word.encode())
        return n


def counter(path: str):
    import regex

    counts, find = Counts(Automaton(entries(path))), regex.compile(WORD).findall

    def run(text: str) -> tuple[int, int]:
        words = find(unicodedata.normalize("NFC", text).lower())
        return len(words), sum(map(counts.__getitem__, words))

    return run


def count_column(text: Column, path: str) -> Column:
    @F.pandas_udf("n_words long, n_tokens long")
    def run(texts: pd.Series) -> pd.DataFrame:
        count = worker_object(("token-counter", path), lambda: counter(path))
        return pd.DataFrame([count(t) for t in texts], columns=["n_words", "n_tokens"], dtype="int64")

    return run(text)


def token_counts(docs: DataFrame, text_col: str = "text", name: str = "tokens", vocab: str = "word_bpe_49k.json",
                 folder: str = TOKENIZERS) -> DataFrame:
    """``docs`` with a struct (n_words, n_tokens) of each whole text."""
    return small_batches(docs).withColumn(name, count_column(text_or_empty(text_col), vocabulary(vocab, folder)))


def op7_token_counts(spark, sf_dir):
    docs = token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "tokens.n_words", "tokens.n_tokens")
