"""Operator 9: best-fit packing of tokenised documents into fixed-length sequences.

A configuration linear program over the histogram of piece lengths is solved by
multiplicative weights.  A configuration is a multiset of lengths that fits in
one sequence; each round prices configurations with an unbounded-knapsack
dynamic program over the current length weights, uses the best one, and lowers
the weights of the lengths it covers, until every length is covered.  The prices
also give a lower bound, and a solution further from it than ``gap`` is solved
again in smaller steps.  The solution is rounded to whole sequences of full configurations, and
best-fit decreasing places what the rounding leaves, whole batches of equal
sequences at a time.

Scale.  Only the histogram (one row per length, at most ``capacity`` rows) and
the list of configurations reach the driver; both are bounded by the capacity,
not by the corpus.  Documents never move: a piece's rank among the pieces of
its length is (rank inside its own task) + (offset of that task), and the rank
alone tells sequence and offset, through a table of the configurations.

Defined results: a NULL text is empty; an empty document is one piece holding
the end token; an empty table gives no rows and no sequences; repeated rows
are packed as often as they occur; other columns of the input are ignored.
"""

import array
import base64
import zlib

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.materialize import materialize
from .common import TOKENIZERS, ship, small_batches, table, text_or_empty, vocabulary, worker_object

ship(__name__)

#: The split pattern of the rank file (fixed value of that vocabulary).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPECIAL = "<|endoftext|>"
SPECIAL_ID = 50256
END_ID = 2
SCALES = (1.0, 0.95, 0.9, 0.8)
#: (eta, largest step) of each pass over the linear program.
PASSES = ((1.0, 1.0), (4.0, 0.5), (4.0, 0.25))


class Ids:
    """Token ids of a whole text as little-endian unsigned 32-bit bytes.

    The ids are those of ``byte_bpe_50k.json`` (the special token in a text is
    one id, as there); they are computed from the rank file of the same
    vocabulary, whose encoder is five times as fast.
    """

    def __init__(self, folder: str):
        import tiktoken

        with open(vocabulary("byte_bpe_50k.tiktoken", folder), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.enc = tiktoken.Encoding("byte_bpe_50k", pat_str=PATTERN, mergeable_ranks=ranks,
                                     special_tokens={SPECIAL: SPECIAL_ID})

    def encode(self, text: str) -> bytes:
        ids = self.enc.encode(text, allowed_special="all") if SPECIAL in text else self.enc.encode_ordinary(text)
        return array.array("I", ids).tobytes()


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole capacities, the shorter piece first."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity
    starts = ([0] if first else []) + list(range(first, n, capacity))
    return [(s, e - s) for s, e in zip(starts, starts[1:] + [n])]


def pieces(docs: DataFrame, id_col: str, text_col: str, capacity: int, end_id: int, folder: str) -> DataFrame:
    """One row per piece, with its rank among the pieces of its length in its task."""
    end = int(end_id).to_bytes(4, "little")

    def run(batches):
        ids = worker_object(("ids", folder), lambda: Ids(folder))
        part, seen = TaskContext.get().partitionId(), [0] * (capacity + 1)
        for batch in batches:
            out = []
            for doc, raw in zip(batch["doc"], map(ids.encode, batch["text"])):
                raw += end
                for k, (s, n) in enumerate(cut(len(raw) // 4, capacity)):
                    out.append((doc, k, s, n, zlib.crc32(raw[4 * s:4 * (s + n)]), part, seen[n]))
                    seen[n] += 1
            yield pd.DataFrame(out, columns=["doc", "piece", "start", "length", "ids_crc32", "part", "rank"])

    src = small_batches(docs).select(F.col(id_col).cast("string").alias("doc"), text_or_empty(text_col).alias("text"))
    got = src.mapInPandas(run, "doc string, piece int, start long, length int, ids_crc32 long, part int, rank long")
    return got.withColumn("doc", F.col("doc").cast(docs.schema[id_col].dataType))


def best_configuration(value: np.ndarray, capacity: int) -> dict[int, int]:
    """Unbounded knapsack: the multiset of lengths <= capacity of the largest total value.

    ``value[l]`` is the value of length l, 0 where l is not wanted.
    """
    best = np.zeros(capacity + 1)
    take = np.zeros(capacity + 1, dtype=np.int64)
    rev = value[::-1]
    for c in range(1, capacity + 1):
        got = best[:c] + rev[capacity - c:capacity]  # best[c - l] + value[l] for l = c .. 1
        i = int(got.argmax())
        if got[i] > best[c - 1]:
            best[c], take[c] = got[i], c - i
        else:
            best[c] = best[c - 1]
    out: dict[int, int] = {}
    c = capacity
    while c > 0:
        n = int(take[c])
        if n == 0:
            c -= 1
            continue
        out[n] = out.get(n, 0) + 1
        c -= n
    return out


def multiplicative_weights(need: np.ndarray, capacity: int, gap: float = 0.01,
                           passes: tuple = PASSES) -> tuple[dict[tuple, float], float]:
    """Fractional solution of the covering LP (configuration -> how many sequences) and a lower bound of it.

    A length's price is its size times exp(-eta * share of its pieces covered).  Each round adds the
    best-priced configuration until one of its lengths is covered whole, or by ``step`` of its pieces, so a
    pass has at most lengths / step rounds and covers every piece exactly once: the solution is feasible as
    it stands.  Prices over the best configuration's price are a dual solution, whose value is the bound.
    While the solution is more than ``gap`` above it, the next (eta, step) is tried; the best pass counts.
    """
    n = need.astype(float)
    size = np.arange(capacity + 1, dtype=float)
    best: dict[tuple, float] = {}
    low, bound = np.inf, 0.0
    for eta, most in passes:
        left, x = n.copy(), {}
        while left.any():
            live = left > 0
            covered = 1 - left[live] / n[live]
            price = np.zeros(capacity + 1)
            price[live] = size[live] * np.exp(-eta * (covered - covered.min()))
            conf = best_configuration(price, capacity)
            bound = max(bound, float(n @ price) / sum(price[k] * a for k, a in conf.items()))
            step = min(min(left[k], n[k] * most) / a for k, a in conf.items())
            for k, a in conf.items():
                left[k] -= a * step
                if left[k] < 1e-9 * n[k]:
                    left[k] = 0.0
            key = tuple(sorted(conf.items(), reverse=True))
            x[key] = x.get(key, 0.0) + step
        if sum(x.values()) < low:
            best, low = x, sum(x.values())
        if low <= bound * (1 + gap):
            break
    return best, bound


def best_fit_rest(need: np.ndarray, capacity: int) -> list[tuple[tuple, int]]:
    """Best-fit decreasing over a histogram, equal sequences in one step.

    Each step takes the longest remaining length, fills the room left with the
    longest lengths that fit, and repeats that sequence until one of its
    lengths runs out, so there are at most as many steps as lengths need.
    """
    left, out = need.copy(), []
    while True:
        there = np.flatnonzero(left)
        if not len(there):
            return out
        conf, room = {}, capacity
        while room:
            fits = there[: np.searchsorted(there, room, "right")]
            fits = fits[left[fits] > 0]
            k = next((int(k) for k in fits[::-1] if left[k] > conf.get(int(k), 0)), 0)
            if not k:
                break
            a = min(room // k, int(left[k]) - conf.get(k, 0))
            conf[k] = conf.get(k, 0) + a
            room -= a * k
        times = min(int(left[k]) // a for k, a in conf.items())
        for k, a in conf.items():
            left[k] -= a * times
        out.append((tuple(sorted(conf.items(), reverse=True)), times))


def rounded(x: dict[tuple, float], need: np.ndarray, capacity: int, scale: float,
            carried: bool) -> tuple[list[tuple[tuple, int]], list[tuple[tuple, int]]]:
    """Whole numbers of the full configurations of ``scale`` times ``x``, and best fit for the rest.

    With ``carried`` the fraction lost by rounding one configuration down is added to the next.
    """
    left, out = need.copy(), []
    carry = 0.0
    for conf, v in sorted(x.items(), key=lambda e: (-e[1], e[0])):
        if sum(k * a for k, a in conf) < capacity:  # what leaves room is left to best fit
            continue
        carry = v * scale + (min(carry, 1.0) if carried else 0.0)
        times = min([int(carry + 1e-9), *(int(left[k]) // a for k, a in conf)])
        if times:
            for k, a in conf:
                left[k] -= a * times
            out.append((conf, times))
            carry -= times
    return out, best_fit_rest(left, capacity)


def sequences(rows: list[tuple[tuple, int]]) -> int:
    return sum(times for _, times in rows)


def plan(hist: dict[int, int], capacity: int, gap: float = 0.01) -> list[tuple[tuple, int]]:
    """Configurations and how many sequences use each; together they hold every piece exactly.

    Rounding strands lengths whose partners are used up, so the fractional solution is rounded in
    several ways; of the plans of fewest sequences the one with most of them from the solution is taken.
    """
    need = np.zeros(capacity + 1, dtype=np.int64)
    for k, v in hist.items():
        need[k] = v
    whole = [(((capacity, 1),), int(need[capacity]))] if need[capacity] else []
    need[capacity] = 0
    if not need.any():
        return whole
    x, _ = multiplicative_weights(need, capacity, gap)
    ways = [rounded(x, need, capacity, s, c) for s in SCALES for c in (False, True)]
    of_lp, rest = min(ways, key=lambda w: (sequences(w[0]) + sequences(w[1]), -sequences(w[0])))
    return whole + of_lp + rest


def placement(plan_rows: list[tuple[tuple, int]], capacity: int) -> dict[int, tuple]:
    """For each length: arrays (first rank, first sequence, pieces a sequence, offset) by rank."""
    rows: dict[int, list] = {}
    ranks, seq = np.zeros(capacity + 1, dtype=np.int64), 0
    for conf, times in plan_rows:
        at = 0
        for k, a in conf:
            rows.setdefault(k, []).append((int(ranks[k]), seq, a, at))
            ranks[k] += a * times
            at += k * a
        seq += times
    return {k: tuple(np.array(c, dtype=np.int64) for c in zip(*v)) for k, v in rows.items()}


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024,
         end_id: int = END_ID, folder: str = TOKENIZERS) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset), one row per piece."""
    cut_up = materialize(pieces(docs, id_col, text_col, capacity, end_id, folder), "pieces")
    by_task = cut_up.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    hist = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    spark = docs.sparkSession
    at = spark.sparkContext.broadcast(placement(plan(hist, capacity), capacity))

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_task.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        n, r = length.to_numpy(), rank.to_numpy()
        seq, off = np.zeros(len(n), dtype=np.int64), np.zeros(len(n), dtype=np.int64)
        order = np.argsort(n, kind="stable")
        values, starts = np.unique(n[order], return_index=True)
        for k, rows in zip(values, np.split(order, starts[1:])):
            first, s, a, o = at.value[int(k)]
            i = np.searchsorted(first, r[rows], "right") - 1
            inside = r[rows] - first[i]
            seq[rows] = s[i] + inside // a[i]
            off[rows] = o[i] + inside % a[i] * k
        return pd.DataFrame({"sequence_id": seq, "offset": off})

    placed = (cut_up.join(offsets, ["part", "length"])
              .withColumn("at", place("length", F.col("rank") + F.col("before"))))
    return placed.select(F.col("doc").alias(id_col), "piece", "start", F.col("length").cast("long").alias("length"),
                         "ids_crc32", "at.sequence_id", "at.offset")


def op9_best_fit_packing(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"))
