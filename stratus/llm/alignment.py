"""Operator 11: cross-tokenizer alignment with an identity-map fast path.

Each text is encoded by tokenizer A (byte-level BPE, of space + text) and by tokenizer B (sentence
pieces, which adds the space).  Byte offsets where a token of A and one of B both end cut the two
sequences into groups; the last A token and the last B token of a group end together and are linked.
The count of an id pair is the number of links in the corpus that hold it.

Method.  An identity map gives each A id the smallest B id of the same bytes.  A group of one A and one B token
that the map foretells is regular: it is counted in a vector as long as A's vocabulary, per task.  Only the
pairs of other groups, combined per task, enter the shuffle that counts pairs.

Scale.  Texts are encoded once; a row of link ids a document is written, no text is shuffled.  Of the
counts the driver gets two vectors, one as long as each vocabulary (a pair's count where the identity map holds,
and the largest count of each B id), and the ``TOP`` most frequent irregular pairs, all of a fixed size.
With these most links are counted where they lie.  Pairs outside the list go through a join on the pair:
each of them holds fewer than 1 / TOP of all irregular links, so no key of that join is hot.  A task holds one batch of
texts and at most ``HELD`` pairs.

Texts are cut before each space that follows a word character or ASCII punctuation.  Neither tokenizer has a token
over such a place (A parts words there, and B has no piece with its space mark after another character, which
:class:`Pair` makes sure of), so tokens, groups and links of a segment do not depend on its neighbours: the
distinct segments of a batch are encoded, and those of up to ``LONG`` characters kept for later batches (twice ``CACHE`` and a batch's at most).

Defined results: NULL and empty texts, and texts whose joined A or B bytes are not space + text (a
piece model reads U+2581 as a space), have no tokens: zeros and an empty string instead of a hash.  Rows are kept as they are,
repeated ones and NULL ids included; an empty table gives no rows; other columns do not matter, whatever their names.
Special tokens' strings inside texts are plain text.
"""

import contextlib
import gc
import hashlib
import json
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.materialize import materialize
from .common import TOKENIZERS, ship, small_batches, table, vocabulary, worker_object

ship(__name__)

TOP = 65_536
HELD = 500_000
CACHE, LONG = 120_000, 48
SEGMENT = re.compile(r"(?<=[\w!-~])(?= )")
CLOSED = re.compile(r"[\w!-~]\Z")
#: Segments that tokenizer A reads in one call.
JOINED = 200
#: Rows of the first pass: a document, a task's regular counts, a task's pair counts.
DOC, REGULAR, PAIRS = 0, 1, 2


def byte_alphabet() -> dict[str, int]:
    """The printable character that byte-level vocabularies write for each byte: itself where
    printable in Latin-1, else the next one from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Pair:
    """Both tokenizers and what follows from their vocabularies."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters = byte_alphabet()
        with open(a_path, encoding="utf-8") as f:
            entries = json.load(f)["model"]["vocab"]
        self.a_bytes = [b""] * (max(entries.values()) + 1)
        for piece, i in entries.items():
            self.a_bytes[i] = bytes(letters[c] for c in piece) if all(c in letters for c in piece) else piece.encode()
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))]
        self.a_size, self.b_size = (np.array([len(x) for x in v], dtype=np.int64) for v in (self.a_bytes, self.b_bytes))
        if any("▁" in self.b.id_to_piece(i).lstrip("▁") for i in range(len(self.b_bytes))):
            raise ValueError(f"{b_path} has pieces over a space: texts cannot be cut there")
        self.space = self.b.piece_to_id("▁")
        first, self.seen, self.before = {}, {}, {}
        for i, x in enumerate(self.b_bytes):
            first.setdefault(x, i)
        self.same = np.array([first.get(x, -1) for x in self.a_bytes], dtype=np.int64)
        # ids with the mark that follows them in the digest: A between and last, B between and last
        na, nb = len(self.a_bytes), len(self.b_bytes)
        self.marked = ([f"{i}," for i in range(na)] + [f"{i}|" for i in range(na)]
                       + [f"{i}," for i in range(nb)] + [f"{i};" for i in range(nb)])

    def ids_a(self, parts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.a.encode_batch_fast(parts, add_special_tokens=False)]

    def encode_a(self, parts: list[str]) -> list[list[int]]:
        """A's ids of each segment.  Segments that could stand before another are read many at a time, since a
        call's own cost is above that of a word, and told apart by the bytes of their tokens."""
        out: list = [None] * len(parts)
        closed = [k for k, p in enumerate(parts) if CLOSED.search(p)]
        groups = [closed[i:i + JOINED] for i in range(0, len(closed), JOINED)]
        for group, ids in zip(groups, self.ids_a(["".join([parts[k] for k in g]) for g in groups])):
            ends = np.cumsum(self.a_size[ids])
            want = np.cumsum([len(parts[k].encode()) for k in group])
            upto = np.searchsorted(ends, want)
            if ends[-1] != want[-1] or (ends[upto] != want).any():
                continue  # tokens that are not these bytes: one by one below
            i = 0
            for k, j in zip(group, (upto + 1).tolist()):
                out[k] = ids[i:j]
                i = j
        alone = [k for k, ids in enumerate(out) if ids is None]
        for k, ids in zip(alone, self.ids_a([parts[k] for k in alone])):
            out[k] = ids
        return out

    def encode(self, parts: list[str]) -> tuple[list, list]:
        """Ids of both for texts that begin with the space that B adds."""
        a = self.encode_a(parts)
        b = [[self.space] if p == " " else ids for p, ids in zip(parts, self.b.encode([p[1:] for p in parts], num_threads=1))]
        return a, b

    def align(self, parts: list[str]) -> list[tuple | None]:
        """(A tokens, B tokens, groups as text, regular A ids, irregular pairs as A id << 32 | B id; both as int64 bytes)
        of each segment; None where the tokens' bytes are not the segment's."""
        ids_a, ids_b = self.encode(parts)
        good, size = [], []
        for k, (p, x, y) in enumerate(zip(parts, ids_a, ids_b)):
            whole = p.encode()
            if b"".join(map(self.a_bytes.__getitem__, x)) == whole == b"".join(map(self.b_bytes.__getitem__, y)):
                good.append(k)
                size.append(len(whole))
        out: list[tuple | None] = [None] * len(parts)
        if not good:
            return out
        n_a, n_b = [len(ids_a[k]) for k in good], [len(ids_b[k]) for k in good]
        a = np.fromiter(chain.from_iterable(ids_a[k] for k in good), dtype=np.int64, count=sum(n_a))
        b = np.fromiter(chain.from_iterable(ids_b[k] for k in good), dtype=np.int64, count=sum(n_b))
        # one behind the other: both sides of a segment have the same bytes
        ends, at_a, at_b = np.intersect1d(np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b]), assume_unique=True,
                                          return_indices=True)
        in_a, in_b = np.diff(at_a, prepend=-1), np.diff(at_b, prepend=-1)
        regular = (in_a == 1) & (in_b == 1) & (self.same[a[at_a]] == b[at_b])
        # A's tokens of a group stand before its B tokens: each moves by the other side's earlier tokens
        all_a, all_b = len(self.a_bytes), len(self.b_bytes)
        mark_a, mark_b = a.copy(), b + 2 * all_a
        mark_a[at_a] += all_a
        mark_b[at_b] += all_b
        order = np.empty(len(a) + len(b), dtype=np.int64)
        order[np.arange(len(a)) + np.repeat(at_b + 1 - in_b, in_a)] = mark_a
        order[np.arange(len(b)) + np.repeat(at_a + 1, in_b)] = mark_b
        text = list(map(self.marked.__getitem__, order.tolist()))
        # kept as bytes: objects that the garbage collector need not visit
        one, pairs = a[at_a[regular]].tobytes(), ((a[at_a] << 32) | b[at_b])[~regular].tobytes()
        groups = np.searchsorted(ends, np.cumsum(size), side="right")  # up to each segment's end
        upto_one = np.concatenate([[0], np.cumsum(regular)])[groups].tolist()
        t = i = j = 0
        for k, na, nb, n, i_end in zip(good, n_a, n_b, groups.tolist(), upto_one):
            t_end, j_end = t + na + nb, n - i_end
            out[k] = na, nb, "".join(text[t:t_end]), one[8 * i:8 * i_end], pairs[8 * j:8 * j_end]
            t, i, j = t_end, i_end, j_end
        return out

    def segments(self, texts: list[str | None]) -> list[list[tuple]]:
        """For each text what :meth:`align` gives for its segments; none where the tokens' bytes are not space + text."""
        cut = [SEGMENT.split(" " + t) if t else [] for t in texts]
        if len(self.seen) > CACHE:  # what the batches since the last time did not meet is forgotten
            self.seen, self.before = {}, self.seen
        seen, before, new = self.seen, self.before, []
        for p in dict.fromkeys(chain.from_iterable(cut)):
            if p not in seen:
                if p in before:
                    seen[p] = before[p]
                else:
                    new.append(p)
        seen.update(zip(new, self.align(new)))
        out = [list(map(seen.__getitem__, parts)) for parts in cut]
        for p in new:
            if len(p) > LONG:
                del seen[p]
        return [[] if None in parts else parts for parts in out]


def pair_of(a_path: str, b_path: str) -> Pair:
    return worker_object(("token-pair", a_path, b_path), lambda: Pair(a_path, b_path))


def counted(keys: np.ndarray, n: np.ndarray):
    """Distinct keys and their added counts."""
    keys, back = np.unique(keys, return_inverse=True)
    return keys, np.bincount(back, weights=n, minlength=len(keys)).astype(np.int64)


@contextlib.contextmanager
def uncollected():
    """No garbage collection: the work makes no reference cycles, and the collector would visit all kept segments."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


LISTS = ("reg_a", "reg_n", "irr_a", "irr_b", "irr_n")


def first_pass(docs: DataFrame, id_col: str, text_col: str, a_path: str, b_path: str) -> DataFrame:
    """Rows of kind DOC (``uid``, id, counts, digest, distinct regular ids and irregular pairs with their numbers),
    and each task's REGULAR and PAIRS counts."""
    src = small_batches(docs).select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    kind = src.schema["doc"].dataType.simpleString()
    schema = (f"kind int, uid long, doc {kind}, n_a long, n_b long, n_groups long, sha string, reg_a array<int>, "
              "reg_n array<long>, irr_a array<int>, irr_b array<int>, irr_n array<long>")

    def run(batches):
        pair = pair_of(a_path, b_path)
        regular = np.zeros(len(pair.a_bytes), dtype=np.int64)
        part, seen, held, size = TaskContext.get().partitionId(), 0, [], 0
        names = ["kind", "uid", "doc", "n_a", "n_b", "n_groups", "sha", *LISTS]
        types = [pa.list_(t) for t in (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64())]
        doc_type = None

        def task_row(what, lists):
            return pa.RecordBatch.from_arrays(
                [pa.array([what], pa.int32()), *(pa.nulls(1, t) for t in (pa.int64(), doc_type, pa.int64(), pa.int64(), pa.int64(), pa.string())),
                 *(pa.array([x], t) for x, t in zip(lists, types))], names)

        def pairs_row():
            keys, n = counted(*map(np.concatenate, zip(*held)))
            return task_row(PAIRS, [[], [], keys >> 32, keys & 0xFFFFFFFF, n])

        for batch in batches:
            doc_type, rows = batch["doc"].type, []
            with uncollected():
                texts = pair.segments(batch["text"].to_pylist())
            for parts in texts:
                if not parts:
                    rows.append((0, 0, 0, "", [], [], [], [], []))
                    continue
                n_a, n_b, groups, same, irregular = zip(*parts)
                one, pairs = (np.frombuffer(b"".join(x), dtype=np.int64) for x in (same, irregular))
                reg_a, reg_n = np.unique(one, return_counts=True)
                keys, irr_n = np.unique(pairs, return_counts=True)
                regular[reg_a] += reg_n
                held.append((keys, irr_n))
                size += len(keys)
                sha = hashlib.sha256("".join(groups)[:-1].encode()).hexdigest()
                rows.append((sum(n_a), sum(n_b), len(one) + len(pairs), sha, reg_a, reg_n, keys >> 32, keys & 0xFFFFFFFF, irr_n))
                if size > HELD:
                    held = [counted(*map(np.concatenate, zip(*held)))]
                    size = len(held[0][0])
                    if size > HELD // 2:
                        yield pairs_row()
                        held, size = [], 0
            n = len(rows)
            cols = list(zip(*rows)) if rows else [()] * 9
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, DOC, "i4")), pa.array((part << 40) + seen + np.arange(n, dtype=np.int64)), batch["doc"],
                 *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string()),
                 *(pa.array(c, t) for c, t in zip(cols[4:], types))], names)
            seen += n
        if seen:
            some = np.flatnonzero(regular)
            yield task_row(REGULAR, [some, regular[some], [], [], []])
            if held:
                yield pairs_row()

    return src.mapInArrow(run, schema)


class Counts:
    """The corpus counts that have a fixed size, to look links up in."""

    def __init__(self, identity, most, top_a, top_b, top_n):
        self.identity, self.most = identity, most
        keys = (top_a << 32) | top_b
        by = np.argsort(keys)
        self.keys, self.n = keys[by], top_n[by]

    def of(self, a: np.ndarray, b: np.ndarray, same: np.ndarray) -> np.ndarray:
        """The pairs' counts, 0 where another pass has to tell."""
        out = np.where(same[a] == b, self.identity[a], 0)
        if len(self.keys):
            k = (a << 32) | b
            at = np.minimum(np.searchsorted(self.keys, k), len(self.keys) - 1)
            out = np.where((out == 0) & (self.keys[at] == k), self.n[at], out)
        return out


def vector(rows, size: int) -> np.ndarray:
    out = np.zeros(size, dtype=np.int64)
    for i, n in rows:
        out[i] = n
    return out


def corpus_counts(seen: DataFrame, pair: Pair):
    """(pairs with their counts, the fixed-size counts) from the task rows of the first pass."""
    spark = seen.sparkSession
    regular = vector(seen.where(F.col("kind") == REGULAR).select(F.explode(F.arrays_zip("reg_a", "reg_n")).alias("r"))
                     .groupBy("r.reg_a").agg(F.sum("r.reg_n")).collect(), len(pair.a_bytes))
    known = [(int(a), int(pair.same[a]), int(regular[a])) for a in np.flatnonzero(regular)]
    known = spark.createDataFrame(known, "a int, b int, n long")  # at most A's vocabulary of rows
    irregular = (seen.where(F.col("kind") == PAIRS).select(F.explode(F.arrays_zip("irr_a", "irr_b", "irr_n")).alias("r"))
                 .select(F.col("r.irr_a").alias("a"), F.col("r.irr_b").alias("b"), F.col("r.irr_n").alias("n")))
    pairs = materialize(known.withColumn("irr", F.lit(0).cast("long")).unionByName(irregular.withColumn("irr", F.col("n")))
                        .groupBy("a", "b").agg(F.sum("n").alias("n"), F.sum("irr").alias("irr")), "pair-counts")
    most = vector(pairs.groupBy("b").agg(F.max("n")).collect(), len(pair.b_bytes))
    top = pairs.where("irr > 0").orderBy(F.desc("irr"), "a", "b").limit(TOP).select("a", "b", "n").collect()
    top = np.array([tuple(r) for r in top], dtype=np.int64).reshape(-1, 3).T
    same = spark.createDataFrame([(a, int(b)) for a, b in enumerate(pair.same) if b >= 0], "a int, b int")
    identity = vector(pairs.join(F.broadcast(same), ["a", "b"]).select("a", "n").collect(), len(pair.a_bytes))
    return pairs, (identity, most, *top)


def second_pass(docs: DataFrame, counts, a_path: str, b_path: str) -> DataFrame:
    """The documents with the sums over links whose counts are at hand, and the other pairs (``cold``)."""
    kind = docs.schema["doc"].dataType.simpleString()
    schema = (f"uid long, doc {kind}, n_a long, n_b long, n_groups long, sha string, n_best long, count_sum long, "
              "cold_a array<int>, cold_b array<int>, cold_n array<long>")
    sent = docs.sparkSession.sparkContext.broadcast(tuple(counts))

    def run(batches):
        pair, known = pair_of(a_path, b_path), Counts(*sent.value)
        kept = ["uid", "doc", "n_a", "n_b", "n_groups", "sha"]
        for batch in batches:
            best, total, cold = [], [], []
            for x in zip(*(batch[c] for c in LISTS)):
                reg_a, reg_n, irr_a, irr_b, irr_n = (c.values.to_numpy(zero_copy_only=False).astype(np.int64) for c in x)
                a, b, n = np.concatenate([reg_a, irr_a]), np.concatenate([pair.same[reg_a], irr_b]), np.concatenate([reg_n, irr_n])
                got = known.of(a, b, pair.same)
                best.append(int(n[(got == known.most[b]) & (got > 0)].sum()))
                total.append(int((got * n).sum()))
                cold.append([x[got == 0] for x in (a, b, n)])
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in kept), pa.array(best, pa.int64()), pa.array(total, pa.int64()),
                 *(pa.array([c[i] for c in cold], pa.list_(t)) for i, t in enumerate((pa.int32(), pa.int32(), pa.int64())))],
                [*kept, "n_best", "count_sum", "cold_a", "cold_b", "cold_n"])

    return docs.mapInArrow(run, schema)


def aligned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_file: str = "byte_bpe_50k.json",
            b_file: str = "piece_bpe_32k.model", folder: str = TOKENIZERS) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for each row.

    ``n_best``: links whose count is the largest of their B id, ties included; ``count_sum``: the links' counts added up.
    """
    a_path, b_path = vocabulary(a_file, folder), vocabulary(b_file, folder)
    seen = materialize(first_pass(docs, id_col, text_col, a_path, b_path), "alignment")
    pairs, counts = corpus_counts(seen, pair_of(a_path, b_path))
    rows = seen.where(F.col("kind") == DOC).select("uid", "doc", "n_a", "n_b", "n_groups", "sha", *LISTS)
    summed = materialize(second_pass(small_batches(rows), counts, a_path, b_path), "alignment-sums")
    cold = (summed.select("uid", F.explode(F.arrays_zip("cold_a", "cold_b", "cold_n")).alias("c"))
            .select("uid", F.col("c.cold_a").alias("a"), F.col("c.cold_b").alias("b"), F.col("c.cold_n").alias("links")))
    best = pairs.sparkSession.createDataFrame([(i, int(n)) for i, n in enumerate(counts[1])], "b int, most long")
    told = cold.join(pairs.select("a", "b", "n"), ["a", "b"]).join(F.broadcast(best), "b")
    more = told.groupBy("uid").agg(F.sum(F.when(F.col("n") == F.col("most"), F.col("links")).otherwise(0)).alias("more_best"),
                                   F.sum(F.col("n") * F.col("links")).alias("more_sum"))
    zero = F.lit(0).cast("long")
    return summed.join(more, "uid", "left").select(
        F.col("doc").alias(id_col), "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"),
        (F.col("n_best") + F.coalesce("more_best", zero)).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", zero)).alias("count_sum"), F.col("sha").alias("groups_sha256"))


def op11_cross_tokenizer_alignment(spark, sf_dir):
    return aligned(table(spark, sf_dir, "documents").select("doc_id", "text"))
