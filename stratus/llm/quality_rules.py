"""Operator 1: quality rules by cross-document line frequency.

Lines are normalised (lower case, digits to 0, white space collapsed) and
hashed.  For each host the distinct texts that hold a line are counted, lines
above the host's limits are removed from every document of that host, and
documents that the removal depletes are rejected, as are those that fail the
base rules on the text itself.

Limits: a line is removed on a host when more than ``min_texts`` texts hold it,
however large the host is, or when more than ``few_texts`` texts and more than
``max_share`` of the host's texts hold it, so that small hosts have a limit they
can reach.  Exact copies of a text count once, so a text is not boilerplate for
having been copied.

Scale.  Lines are counted over distinct (host, hash of text) pairs after a
map-side combine, so a group of copies costs one entry.  Counts are partial
aggregates over hashes.  Up to ``listed`` frequent lines (8 bytes each) are
joined back as one list a host, so that texts do not move.  Beyond it the lists
would grow with the hosts: each text's own lines are then joined to them by host
and hash, and a text gets back the list of its own frequent lines only.

Defined results: a NULL text is empty (no words, fails the base rules); a NULL
host is a host of its own; repeated rows give repeated results; an empty table
gives no rows; extra columns are ignored, whatever their names; a column of the
result's name is replaced, and ``name`` chooses another.
"""

import re

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.materialize import materialize
from .common import fresh, null_safe_key, ship, small_batches, table, text_or_empty

ship(__name__)

SYMBOLS = re.compile(r"[#*$%&|<>]")
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PCT = 30
MIN_TEXTS = 20
FEW_TEXTS = 5
MAX_SHARE = 0.1
LISTED = 1 << 20

DIGITS = re.compile(rb"[0-9]+")


def repeat_words(words: list, window: int = WINDOW) -> int:
    """Words inside windows of ``window`` words that occur twice or more, first ones included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    ids: dict = {}
    run = np.fromiter((ids.setdefault(w, len(ids)) for w in words), dtype=np.int64, count=len(words))
    size = 1
    while size < window:  # exact identity of windows of 2, 4, 8 words
        run = np.unique(run[:-size] * (int(run.max()) + 1) + run[size:], return_inverse=True)[1]
        size *= 2
    again = np.bincount(run)[run] > 1
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    at = np.flatnonzero(again)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return int((np.cumsum(edge) > 0).sum())


def text_facts(text: str) -> tuple:
    words = text.encode().split()  # bytes split on the ASCII white space only
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line.encode().split():
            dup += line in seen
            seen.add(line)
    chars = len(text) - sum(text.count(c) for c in " \t\n\v\f\r")
    return len(words), chars, len(SYMBOLS.findall(text)), dup, repeat_words(words)


def line_facts(line: str) -> tuple[int, int]:
    """(signed hash of the normalised line, its words)."""
    words = line.lower().encode().split()
    h = xxhash.xxh64_intdigest(DIGITS.sub(b"0", b" ".join(words)))
    return (h - (1 << 64) if h >> 63 else h), len(words)


def lines_column(text: Column) -> Column:
    """Hashes of the distinct lines that have a word."""
    @F.pandas_udf("array<long>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([np.array(sorted({h for h, n in map(line_facts, t.split("\n")) if n}), dtype=np.int64) for t in texts],
                         dtype=object)

    return run(text)


def without_lines(text: str, gone: set) -> tuple[int, str]:
    """(words removed, the text without the lines of these hashes)."""
    left, out = [], 0
    for line in text.split("\n"):
        h, n = line_facts(line)
        if n and h in gone:
            out += n
        else:
            left.append(line)
    return out, "\n".join(left)


def facts_column(text: Column, gone: Column, clean: bool) -> Column:
    """The base facts of a text, the words in lines of these hashes (NULL: none) and, if ``clean``, the text without them."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_removed_words"]
    kinds = ", ".join(f"{n} long" for n in names) + (", clean_text string" if clean else "")

    @F.pandas_udf(kinds)
    def run(texts: pd.Series, hashes: pd.Series) -> pd.DataFrame:
        rest = [(0, t) if g is None else without_lines(t, set(g.tolist())) for t, g in zip(texts, hashes)]
        out = pd.DataFrame([(*text_facts(t), n) for t, (n, _) in zip(texts, rest)], columns=names, dtype="int64")
        if clean:
            out["clean_text"] = pd.Series([t for _, t in rest], dtype=object)
        return out

    return run.asNondeterministic()(text, gone)  # else a filter on the facts computes them a second time, in workers of its own


def text_key(host_col: str, text: Column) -> list[Column]:
    return [null_safe_key(host_col).alias("_host"), F.xxhash64(text).alias("_t1"), F.hash(text).alias("_t2")]


def frequent_lines(docs: DataFrame, text_col: str = "text", host_col: str = "source", min_texts: int = MIN_TEXTS,
                   max_share: float = MAX_SHARE, few_texts: int = FEW_TEXTS) -> tuple[DataFrame, DataFrame]:
    """(_host, _t1, _t2, _lines): the lines of every distinct text of a host, and (_host, h): those above its limits."""
    text = text_or_empty(text_col)
    texts = docs.select(*text_key(host_col, text), lines_column(text).alias("_lines"))
    texts = materialize(texts.groupBy("_host", "_t1", "_t2").agg(F.first("_lines").alias("_lines")), "text-lines")
    hosts = texts.groupBy("_host").agg(F.count(F.lit(1)).alias("n_host"))
    held = (texts.select("_host", F.explode("_lines").alias("h"))
            .groupBy("_host", "h").agg(F.count(F.lit(1)).alias("n_texts")).where(F.col("n_texts") > min(few_texts, min_texts)))
    n = F.col("n_texts")
    often = held.join(hosts, "_host").where((n > min_texts) | ((n > few_texts) & (n > F.col("n_host") * max_share)))
    return texts, materialize(often.select("_host", "h"), "frequent-lines")


def apply_rules(docs: DataFrame, text_col: str = "text", host_col: str = "source", min_texts: int = MIN_TEXTS,
                max_share: float = MAX_SHARE, min_words: int = MIN_WORDS, clean: bool = True,
                name: str = "quality", few_texts: int = FEW_TEXTS, listed: int = LISTED) -> DataFrame:
    """``docs`` with a struct column ``name``: the base facts, ``base_failed``, ``n_removed_words``,
    ``kept`` and, if ``clean``, ``clean_text`` (the text without the removed lines).

    A document is depleted when a line was removed and fewer than ``min_words`` words, or less than
    half of its words, are left.
    """
    small_batches(docs)
    facts = fresh(docs, "_facts")
    texts, often = frequent_lines(docs, text_col, host_col, min_texts, max_share, few_texts)
    if often.count() <= listed:
        keys, gone = ["_host"], often
    else:
        # lists of hashes and repeated hosts are small as written: Spark would broadcast millions of rows
        keys, gone = ["_host", "_t1", "_t2"], texts.withColumn("h", F.explode("_lines")).join(often.hint("merge"), ["_host", "h"])
    gone = gone.groupBy(*keys).agg(F.collect_list("h").alias("_often"))
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("_row"), *text_key(host_col, text_or_empty(text_col))[:len(keys)])
    rows = rows.join(gone, keys, "left").select("_row", F.col("_often").alias("g_often"))
    text = F.col("_row")[text_col]
    rows = rows.withColumn(facts, facts_column(text_or_empty(text), F.col("g_often"), clean))
    f = F.col(facts)
    failed = (f["n_words"] < min_words) | (100 * f["n_repeat_words"] > MAX_REPEAT_PCT * f["n_words"])
    left = f["n_words"] - f["n_removed_words"]
    depleted = (f["n_removed_words"] > 0) & ((left < min_words) | (2 * left < f["n_words"]))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    quality = F.struct(*[f[n].alias(n) for n in names], failed.alias("base_failed"), f["n_removed_words"].alias("n_removed_words"),
                       (~failed & ~depleted).alias("kept"),
                       *([F.when(text.isNotNull(), f["clean_text"]).alias("clean_text")] if clean else []))
    return rows.select(*[F.col("_row")[c].alias(c) for c in docs.columns if c.lower() != name.lower()], quality.alias(name))


def op1_quality_rules(spark, sf_dir):
    docs = apply_rules(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), clean=False)
    q = F.col("quality")
    return docs.select("doc_id", *[q[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines",
                                                           "n_repeat_words", "base_failed", "n_removed_words", "kept")])


#: The same result in DuckDB: words by regexp, windows by joined word slices, line counts by host.
OP1_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, source FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d),
win AS (SELECT rid, p, array_to_string(list_slice(words, p, p + 7), ' ') AS g
        FROM (SELECT rid, words, unnest(range(1, len(words) - 6)) AS p FROM w WHERE len(words) >= 8)),
rep AS (SELECT rid, p FROM (SELECT rid, p, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT rid, count(DISTINCT pos) AS n_repeat_words
        FROM (SELECT rid, unnest(range(p, p + 8)) AS pos FROM rep) GROUP BY rid),
raw AS (SELECT rid, doc_id, source, text, unnest(string_split(text, chr(10))) AS line FROM d),
ln AS (SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS nw,
              lower(trim(regexp_replace(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g'), '[0-9]+', '0', 'g'), ' ')) AS norm
       FROM raw),
real AS (SELECT * FROM ln WHERE nw > 0),
dup AS (SELECT rid, count(*) - count(DISTINCT line) AS n_dup_lines FROM real GROUP BY rid),
hosts AS (SELECT source, count(DISTINCT text) AS n_host FROM d GROUP BY source),
held AS (SELECT source, norm, count(DISTINCT text) AS n_texts FROM real GROUP BY source, norm),
often AS (SELECT held.source, norm FROM held JOIN hosts ON held.source IS NOT DISTINCT FROM hosts.source
          WHERE n_texts > 20 OR (n_texts > 5 AND n_texts > n_host * 0.1)),
gone AS (SELECT rid, sum(nw) AS n_removed_words FROM real JOIN often
         ON real.source IS NOT DISTINCT FROM often.source AND real.norm = often.norm GROUP BY rid),
f AS (SELECT w.doc_id, len(words) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
             len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words, CAST(coalesce(n_removed_words, 0) AS BIGINT) AS n_removed_words
      FROM w LEFT JOIN cov USING (rid) LEFT JOIN dup USING (rid) LEFT JOIN gone USING (rid))
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
       AND NOT (n_removed_words > 0 AND (n_words - n_removed_words < 20 OR 2 * (n_words - n_removed_words) < n_words)) AS kept
FROM f
"""
