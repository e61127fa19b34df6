"""Operator 13: lines that many documents repeat, found over range-partitioned line hashes.

Each line of at least ``min_chars`` code points (white space stripped at both ends, A-Z lowered)
becomes a 128-bit hash.  The hashes are range-partitioned and sorted by (hash, document
descending, position), so that a line's first occurrence in the stream is the one in the largest
document.  One pass streams over each partition: it keeps the first document of a hash and, once
``min_docs`` documents held it, reports the lines of all others.  What comes back is one
compressed bitmap a document that loses lines, never a text.

Scale.  Only (document, text hash, line hash, position) is shuffled.  The range key goes down to
the position, so a line that a third of all documents hold spreads over many partitions.  A hash
met at a partition's edge is decided afterwards: a partition reports its first and last hash with
the number of documents (two rows a partition, all that reaches the driver), its rows of them are
marked as undecided, and the verdicts, at most one a partition, are joined back.  A task holds
one Arrow batch and the lines of fewer than ``min_docs`` documents of one hash.

A document is a doc_id (integer or string): rows that repeat one count as one document, and each
keeps or loses lines by its own text.  Defined results: a NULL or empty text is one empty line; a
NULL doc_id is a document, smaller than all others; a line repeated in the largest document stays
there each time; an empty table gives no rows; other columns do not matter, whatever their names.
"""

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import partitions_for
from ..sources.materialize import materialize
from .common import fresh, ship, small_batches, table, text_or_empty

ship(__name__)

MIN_CHARS, MIN_DOCS = 40, 5
SPACE = b" \t\n\x0b\x0c\r"
#: What a row of the streaming pass is: a line that goes, one of an edge hash, an edge itself.
DROP, OPEN, EDGE = 0, 1, 2


def line_keys(text: bytes, min_chars: int) -> list[tuple[int, bytes]]:
    """(position, key) of the lines whose key has at least ``min_chars`` code points."""
    out = []
    for i, line in enumerate(text.split(b"\n")):
        if len(line) >= min_chars:
            key = line.strip(SPACE).lower()  # bytes: A-Z only
            # a code point has one to four bytes
            if len(key) >= 4 * min_chars or len(key) >= min_chars and len(key.decode()) >= min_chars:
                out.append((i, key))
    return out


def hashed_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(doc, th, h1, h2, pos): a row per line long enough; ``th`` tells rows that repeat a doc_id apart."""
    src = small_batches(docs).select(F.col(id_col).alias("doc"), F.xxhash64(F.col(text_col)).alias("th"),
                                     F.col(text_col).cast("binary").alias("text")).where(F.col("text").isNotNull())
    schema = src.select("doc", "th").schema.add("h1", "long").add("h2", "long").add("pos", "integer")

    def run(batches):
        for batch in batches:
            rows, digests, at = [], [], []
            for r, text in enumerate(batch["text"].to_pylist()):
                for pos, key in line_keys(text, min_chars):
                    rows.append(r)
                    at.append(pos)
                    digests.append(xxhash.xxh128_digest(key))
            h = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
            keep = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch["doc"].take(keep), batch["th"].take(keep), pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy()),
                 pa.array(at, pa.int32())], ["doc", "th", "h1", "h2", "pos"])

    return src.mapInArrow(run, schema)


class Stream:
    """First occurrences over rows sorted by (hash, document descending)."""

    def __init__(self, min_docs: int, part: int):
        self.min_docs, self.part = min_docs, part
        self.key = None       # the open hash
        self.docs = 0         # its documents so far
        self.first = self.last = None
        self.opening = True   # the open hash began the partition
        self.held: list = []  # its lines outside its first document, while too few documents hold it
        self.out: list = []
        self.edges: list = []

    def add(self, batch: pa.RecordBatch) -> None:
        n = batch.num_rows
        h1, h2 = (batch[c].to_numpy() for c in ("h1", "h2"))
        ids = batch["doc"]
        none = ids.is_null().to_numpy(zero_copy_only=False)
        doc = ids.fill_null(0 if pa.types.is_integer(ids.type) else "").to_numpy(zero_copy_only=False)
        new_key = np.ones(n, dtype=bool)
        new_key[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        new_doc = new_key.copy()
        new_doc[1:] |= (doc[1:] != doc[:-1]) | (none[1:] != none[:-1])
        if self.key is None:
            self._begin(batch, 0, opening=True)
            new_key[0] = False
        elif self.key == (h1[0], h2[0]):
            new_key[0], new_doc[0] = False, ids[0].as_py() != self.last
        starts = np.flatnonzero(new_key)
        if not len(starts):
            self._extend(batch, new_doc, 0, n)
            return
        if starts[0]:
            self._extend(batch, new_doc, 0, starts[0])
        self._close()
        a, b = int(starts[0]), int(starts[-1])  # hashes that begin and end in between
        size, docs = np.diff(starts), np.cumsum(new_doc)
        held_by = docs[starts[1:] - 1] - docs[starts[:-1]] + 1
        later = docs[a:b] > np.repeat(docs[starts[:-1]], size)
        self._emit(DROP, batch.slice(a, b - a).filter(pa.array(later & np.repeat(held_by >= self.min_docs, size))))
        self._begin(batch, b, opening=False)
        self._extend(batch, new_doc, b, n)

    def _begin(self, batch, at: int, opening: bool) -> None:
        self.key = (batch["h1"][at].as_py(), batch["h2"][at].as_py())
        self.docs, self.first, self.opening, self.held = 0, batch["doc"][at].as_py(), opening, []

    def _extend(self, batch, new_doc, a: int, b: int) -> None:
        """Rows a to b belong to the open hash."""
        ordinal = self.docs + np.cumsum(new_doc[a:b])
        self.docs, self.last = int(ordinal[-1]), batch["doc"][int(b) - 1].as_py()
        rows = batch.slice(a, b - a)
        if self.opening:
            self._emit(OPEN, rows)
            return
        self.held.append(rows.filter(pa.array(ordinal > 1)))
        if self.docs >= self.min_docs:
            for x in self.held:
                self._emit(DROP, x)
            self.held = []

    def _close(self) -> None:
        """The open hash ends inside the partition."""
        if self.key is not None and self.opening:
            self._edge()
        self.held = []

    def end(self) -> None:
        if self.key is not None:
            for x in self.held:
                self._emit(OPEN, x)
            self._edge()

    def _edge(self) -> None:
        self.edges.append((*self.key, self.docs, self.first, self.last))

    def _emit(self, kind: int, rows: pa.RecordBatch) -> None:
        if rows.num_rows:
            self.out.append((kind, rows))


def repeats(lines: DataFrame, min_docs: int) -> DataFrame:
    """(doc, th, pos) of the lines that go."""
    kind = lines.schema["doc"].dataType.simpleString()
    key = ("h1", "h2", F.col("doc").desc(), "th", "pos")
    laid = lines.repartitionByRange(partitions_for(lines), *key).sortWithinPartitions(*key)
    schema = f"kind int, part int, doc {kind}, th long, h1 long, h2 long, pos int, docs long, last {kind}"

    def run(batches):
        stream = Stream(min_docs, TaskContext.get().partitionId())
        kind_of = None

        def flush():
            for what, rows in stream.out:
                n = rows.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, what, "i4")), pa.array(np.full(n, stream.part, "i4")), rows["doc"], rows["th"],
                     rows["h1"], rows["h2"], rows["pos"], pa.nulls(n, pa.int64()), pa.nulls(n, rows["doc"].type)], names)
            stream.out = []

        names = ["kind", "part", "doc", "th", "h1", "h2", "pos", "docs", "last"]
        for batch in batches:
            if batch.num_rows:
                kind_of = batch["doc"].type
                stream.add(batch)
                yield from flush()
        stream.end()
        yield from flush()
        if stream.edges:
            h1, h2, docs, first, last = zip(*stream.edges)
            n = len(h1)
            yield pa.RecordBatch.from_arrays(
                [pa.array([EDGE] * n, pa.int32()), pa.array([stream.part] * n, pa.int32()), pa.array(first, kind_of),
                 pa.nulls(n, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.nulls(n, pa.int32()),
                 pa.array(docs, pa.int64()), pa.array(last, kind_of)], names)

    found = materialize(laid.mapInArrow(run, schema), "repeated-lines")
    drops = found.where(F.col("kind") == DROP).select("doc", "th", "pos")
    edges = found.where(F.col("kind") == EDGE).select("part", "h1", "h2", "doc", "docs", "last").collect()
    verdicts = edge_verdicts(sorted((tuple(e) for e in edges), key=lambda e: e[:3]), min_docs)
    if not verdicts:
        return drops
    known = lines.sparkSession.createDataFrame(verdicts, f"e1 long, e2 long, keeper {kind}")
    edge = found.where(F.col("kind") == OPEN).join(
        F.broadcast(known), (F.col("h1") == F.col("e1")) & (F.col("h2") == F.col("e2")) & ~F.col("doc").eqNullSafe(F.col("keeper")))
    return drops.unionByName(edge.select("doc", "th", "pos"))


def edge_verdicts(edges: list[tuple], min_docs: int) -> list[tuple]:
    """(h1, h2, document that keeps it) of the edge hashes in enough documents.

    ``edges``: (part, h1, h2, first document, documents, last document), in order; a hash that
    goes on in the next partition counts a document on both sides of the border once.
    """
    out, key, docs, keeper, last = [], None, 0, None, None
    for _, h1, h2, first, n, end in [*edges, (None,) * 6]:
        if (h1, h2) == key:
            docs += n - (first == last)
        else:
            if key and docs >= min_docs:
                out.append((*key, keeper))
            key, docs, keeper = (h1, h2), n, first
        last = end
    return out


def bitmap_of(dropped: np.ndarray) -> bytes:
    """A compressed bitmap, one bit a line, up to the byte of the last line that goes: 1 stays, 0 goes; later lines stay."""
    keep = np.ones((int(dropped.max()) // 8 + 1) * 8, dtype=bool)
    keep[dropped] = False
    return zlib.compress(np.packbits(keep).tobytes())


def kept_lines(text: str, bitmap: bytes) -> str:
    lines = text.split("\n")
    keep = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), dtype=np.uint8)).tolist()
    return "\n".join([x for x, k in zip(lines, keep) if k] + lines[len(keep):])


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                 min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc, th, n_dropped, keep) of each document that loses lines: ``th`` is xxhash64 of its text,
    ``keep`` the bitmap that :func:`kept_lines` applies."""
    gone = repeats(hashed_lines(docs, id_col, text_col, min_chars), min_docs)

    @F.pandas_udf("binary")
    def pack(dropped: pd.Series) -> pd.Series:
        return dropped.map(bitmap_of)

    rows = small_batches(gone).groupBy("doc", "th").agg(F.collect_set("pos").alias("gone"))
    return rows.select("doc", "th", F.size("gone").cast("long").alias("n_dropped"), pack("gone").alias("keep"))


def drop_lines(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               n_dropped: str = "n_dropped", kept_text: str = "kept_text") -> DataFrame:
    """``docs`` with the text that stays and the number of lines gone, from :func:`keep_bitmaps`.

    Taken names get underscores in front (:func:`.common.fresh`), as everywhere here.
    """
    doc, th, n, keep = (fresh(docs, f"_dedup_{c}") for c in ("doc", "th", "n", "keep"))
    marks = bitmaps.select(F.col("doc").alias(doc), F.col("th").alias(th), F.col("n_dropped").alias(n), F.col("keep").alias(keep))
    # one plan at every size: a small table of marks would be broadcast, a larger one shuffles the texts, a step in the disk taken
    rows = docs.join(marks.hint("merge"), F.col(id_col).eqNullSafe(F.col(doc)) & (F.xxhash64(F.col(text_col)) == F.col(th)), "left")
    # texts that lose nothing are not sent to Python
    text = F.coalesce(kept_column(F.when(F.col(keep).isNotNull(), F.col(text_col)), F.col(keep)), text_or_empty(text_col))
    names = fresh(docs, n_dropped), fresh(docs, kept_text)
    return small_batches(rows).select(*docs.columns, F.coalesce(F.col(n), F.lit(0).cast("long")).alias(names[0]),
                                      text.alias(names[1]))


def kept_column(text: Column, bitmap: Column) -> Column:
    @F.pandas_udf("string")
    def run(texts: pd.Series, bitmaps: pd.Series) -> pd.Series:
        return pd.Series([None if b is None else kept_lines(t, b) for t, b in zip(texts, bitmaps)], dtype=object)

    return run(text, bitmap)


def n_lines(text_col: str) -> Column:
    text = text_or_empty(text_col)
    return (F.length(text) - F.length(F.translate(text, "\n", "")) + 1).cast("long")


def op13_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = drop_lines(docs, keep_bitmaps(docs))
    return rows.select("doc_id", n_lines("text").alias("n_lines"), "n_dropped",
                       F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


OP13_SQL = """
WITH lines AS (
  SELECT rowid_, doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT rowid_, doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos
        FROM (SELECT row_number() OVER () AS rowid_, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))
), common AS (
  SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
)
SELECT any_value(l.doc_id) AS doc_id, count(*) AS n_lines,
       count(*) FILTER (c.key IS NOT NULL AND l.doc_id <> c.keeper) AS n_dropped,
       sha256(coalesce(string_agg(l.line, chr(10) ORDER BY l.pos)
                       FILTER (c.key IS NULL OR l.doc_id = c.keeper), '')) AS kept_sha256
FROM lines l LEFT JOIN common c ON l.key = c.key GROUP BY l.rowid_
"""
