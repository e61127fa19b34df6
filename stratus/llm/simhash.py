"""Operator 8: SimHash near-duplicates through deletion-variant signatures.

A fingerprint has 64 bits; two texts link when theirs differ in at most
``max_bits`` (3).  The 64 bits are cut into ``max_bits // 2 + 1`` segments (2),
fewer than the usual ``max_bits + 1``, so that of two linked fingerprints some
segment differs in at most one bit.  Each segment is indexed as it is and with
each bit in turn replaced by a wildcard; an equality join of these signatures
finds every candidate pair and the exact bit distance verifies it.  The two
values of a wildcard bit stand on the two sides of the join, so a candidate is
met at the bit in which its segment differs, not at every wildcard.

Scale.  Equal fingerprints are one row before any signature is made, so
copies cost nothing.  A segment value with more than ``bucket`` fingerprints
is hot: hot rows join cold rows (at most ``bucket`` for each wildcard), and
hot rows among themselves are indexed again inside their signature by the
segments of the remaining bits, until few enough bits are left that a group
is bounded by their number.  No pair is lost and no group is paired whole.

Defined results: NULL and empty texts have fingerprint zero and link like any
other; a NULL doc_id is never a component id unless its whole component has
none; repeated rows are kept; other columns are ignored; an empty table gives
no rows.
"""

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.materialize import materialize
from .common import fresh, null_safe_key, ship, small_batches, table, text_or_empty
from .components import components

ship(__name__)

BITS = 64
SEED = 42
_BLOCK = 65_536


def fingerprint(text: str, shingle_words: int = 3) -> int:
    """Signed 64-bit SimHash of the word shingles, repeats included."""
    words = text.encode().lower().split()  # bytes: A-Z only, and the ASCII white space \x20 \x09-\x0d
    if not words:
        return 0
    if len(words) < shingle_words:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        line = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        h = xxhash.xxh64_intdigest
        hashes = [h(line[s:e], SEED) for s, e in zip(starts[:len(words) - shingle_words + 1].tolist(),
                                                     ends[shingle_words - 1:].tolist())]
    ones = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(hashes), _BLOCK):
        block = np.array(hashes[i:i + _BLOCK], dtype="<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprint_column(text: Column, shingle_words: int) -> Column:
    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle_words) for t in texts], dtype="int64")

    return run(text)


def _segments(lo: int, width: int, max_bits: int) -> list[tuple[int, int]]:
    n = max_bits // 2 + 1
    cuts = [lo + width * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _value(fp: Column, lo: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, lo).bitwiseAND(F.lit((1 << width) - 1)) if width < BITS else fp


def _variants(rows: DataFrame, side: int | None) -> DataFrame:
    """(key, fp) of each row's signatures: the exact segment, and the wildcards of one side of
    the join (bit 0 or 1; ``None``: all).  ``rows``: grp, fp, lo, width, val."""
    wild = F.sequence(F.lit(0), F.col("width") - 1)
    if side is not None:
        wild = F.filter(wild, lambda p: F.call_function("getbit", F.col("val"), p) == side)
    keys = F.transform(wild, lambda p: F.xxhash64("grp", "lo", p, F.col("val").bitwiseAND(
        F.bitwise_not(F.call_function("shiftleft", F.lit(1).cast("long"), p)))))
    keys = F.concat(F.array(F.xxhash64("grp", "lo", F.lit(-1), "val")), keys)
    return rows.select(F.explode(keys).alias("key"), "fp")


def _join(left: DataFrame, right: DataFrame, max_bits: int) -> DataFrame:
    l, r = left.select("key", F.col("fp").alias("a")), right.select("key", F.col("fp").alias("b"))
    far = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    # Spark sizes signatures as the rows before the explode, a few tens of times too low: it would broadcast them
    return l.join(r.hint("merge"), (l["key"] == r["key"]) & (far >= 1) & (far <= max_bits)).select("a", "b")


def _pairs(members: DataFrame, lo: int, width: int, max_bits: int, bucket: int) -> DataFrame:
    """Pairs of a group within ``max_bits``, for (grp, fp) whose other bits were matched before."""
    if width <= 8:
        keyed = members.select(F.col("grp").alias("key"), "fp")
        return _join(keyed, keyed, max_bits)
    segs = _segments(lo, width, max_bits)
    rows = members.select("grp", "fp", F.explode(F.array(*[
        F.struct(F.lit(a).alias("lo"), F.lit(n).alias("width"), _value(F.col("fp"), a, n).alias("val"))
        for a, n in segs])).alias("s")).select("grp", "fp", "s.lo", "s.width", "s.val")
    hot = materialize(rows.groupBy("grp", "lo", "val").count().where(F.col("count") > bucket)
                      .select("grp", "lo", "val", F.lit(True).alias("hot")), "hot-segments")
    if hot.isEmpty():
        return _join(_variants(rows, 0), _variants(rows, 1), max_bits)
    marked = materialize(rows.join(hot, ["grp", "lo", "val"], "left")
                         .withColumn("hot", F.coalesce("hot", F.lit(False))), "segments")
    cold, warm = marked.where(~F.col("hot")), marked.where("hot")
    out = _join(_variants(cold, 0), _variants(cold, 1), max_bits)
    out = out.union(_join(_variants(warm, 0), _variants(cold, 1), max_bits))
    out = out.union(_join(_variants(cold, 0), _variants(warm, 1), max_bits))
    for a, n in segs:
        rest_lo, rest = max(((b, m) for b, m in segs if b != a), key=lambda s: s[1], default=(0, 0))
        inner = _variants(warm.where(F.col("lo") == a), None).select(F.col("key").alias("grp"), "fp")
        out = out.union(_pairs(materialize(inner, "hot-members"), rest_lo, rest, max_bits, bucket))
    return out


def near_pairs(fingerprints: DataFrame, max_bits: int = 3, bucket: int = 128) -> DataFrame:
    """(a, b), a < b: all pairs of distinct values of column ``fp`` that differ in 1 to ``max_bits`` bits."""
    members = fingerprints.select(F.lit(0).cast("long").alias("grp"), "fp").distinct()
    found = _pairs(members, 0, BITS, max_bits, bucket)
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle_words: int) -> DataFrame:
    """(doc, th, fp) per row: id, a hash of the text, and the fingerprint; written once."""
    text = text_or_empty(text_col)
    return materialize(small_batches(docs).select(F.col(id_col).alias("doc"), F.xxhash64(F.col(text_col)).alias("th"),
                                   fingerprint_column(text, shingle_words).alias("fp")), "fingerprints")


def classes(prints: DataFrame, max_bits: int, bucket: int) -> DataFrame:
    """(fp, component): the smallest id reachable from each distinct fingerprint.

    The smallest id of a component is found over fingerprints, not over documents: each
    fingerprint carries its own smallest (id, text hash), NULL ids last.
    """
    reps = materialize(prints.groupBy("fp").agg(F.min(F.struct(
        F.col("doc").isNull().alias("none"), "doc", "th", F.col("fp").alias("print"))).alias("rep")), "reps")
    pairs = materialize(near_pairs(reps, max_bits, bucket), "pairs")
    # pairs of dense clusters are a few bytes each as written, ten times that in a broadcast
    ends = reps.select(F.col("fp").alias("a"), F.col("rep").alias("ra")).hint("merge")
    edges = (pairs.join(ends, "a").join(ends.select(F.col("a").alias("b"), F.col("ra").alias("rb")).hint("merge"), "b")
             .select(F.col("ra").alias("a"), F.col("rb").alias("b")))
    found = components(materialize(edges, "ends")).select(F.col("node.print").alias("fp"), "root")
    return materialize(reps.join(found, "fp", "left").select("fp", F.coalesce("root", "rep").alias("root")), "classes")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3,
                    max_bits: int = 3, bucket: int = 128) -> DataFrame:
    """(id, fingerprint, component_id) for each row."""
    prints = fingerprints(docs, id_col, text_col, shingle_words)
    cls = classes(prints, max_bits, bucket).select("fp", F.col("root.doc").alias("component_id"))
    return prints.join(cls, "fp", "left").select(F.col("doc").alias(id_col), hex_fingerprint(F.col("fp")).alias("fingerprint"),
                                                 "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3,
                         max_bits: int = 3, bucket: int = 128) -> DataFrame:
    """The documents without all but one of each class: the row of the smallest (id, text hash).

    Of rows that agree in id and text one stays.
    """
    prints = fingerprints(docs, id_col, text_col, shingle_words)
    kept = classes(prints, max_bits, bucket).select(
        null_safe_key("root.doc").alias("_k"), F.col("root.th").alias("_th")).distinct()
    key, th = fresh(docs, "_id_key"), fresh(docs, "_text_key")
    # repeated rows first, combined before the one shuffle of the texts; the semi join reuses its partitioning
    rows = docs.withColumns({key: null_safe_key(id_col), th: F.xxhash64(F.col(text_col))}).dropDuplicates([key, th])
    rows = rows.join(kept, (F.col(key) == kept["_k"]) & (F.col(th) == kept["_th"]), "left_semi")
    return rows.select(*docs.columns)


def op8_simhash_near_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))
