"""Operator 5: benchmark decontamination through CGK embedding and bit-sampling LSH.

The CGK embedding walks over a string with a pointer that, after each output
symbol, moves on or stays by a random bit of (step, symbol); two strings at a
small edit distance then give outputs at a small Hamming distance.  Here the
symbols are words.  Windows of the documents, about as long as the benchmark
items, are embedded; each repetition samples a few output positions, and a
window whose sampled words equal those of an item's window is a candidate.
Candidates are verified by the exact edit distance of the whole item to the
best-fitting stretch of the document.

Windows.  Items of fewer than ``ONE_CLASS`` words are dealt into classes of
similar length (ratio 1.35), all longer ones are one class.  In a class whose
shortest item has n words (``LONG`` at most count) the stride is n // 4 and a
window has n - 2 * stride + 1 words, so every whole occurrence of an item holds
at least two document windows, and one of a long item many, of which those with
few edits hit; of the item all windows are indexed.

Repetitions follow from ``target_recall``: edits at the limit (one word in
five) are simulated on the shortest items of a class, the hardest, and walks of
``PER_WALK`` repetitions are added, as many as it takes, until those of every
length are found with the target's probability.

Windows in which too few words occur in any item are left out before the walks:
a running sum over one bitmap lookup a word tells.  The simulation leaves the
same windows out, so the target holds with this filter.

Scale.  One pass over the documents for each block of items, no shuffle: the
items travel in blocks of at most ``block_bytes`` of text (a stated query set
against all rows, in blocks), whose index takes some hundred times as much.
With more than one block the rows are written once and each block's leaks are
written on their own, so a worker holds one index at a time.  The index is sent as
plain arrays, which a worker holds once and only while a stage uses them, and needs no
copy of this package.  Words are
compared as words in the verification; hashes only find candidates.

Defined results: NULL texts are empty; items of fewer than ``min_words`` words
are too short to be evidence and are skipped; a repeated item is reported
under each of its ids, a repeated document once per row; empty tables give no
rows; extra columns are ignored.
"""

import zlib
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.materialize import materialize
from .common import fresh, ship, small_batches, table, text_or_empty

ship(__name__)

SAMPLE = 5           # output positions in one repetition
PER_WALK = 32        # repetitions over one embedding
RATIO = 1.35
ONE_CLASS, LONG = 14, 20
SIMULATED, LENGTHS = 400, 8  # samples for each of the shortest lengths of a class
STALLED = 50         # walks in a row that find nothing new
FILTER_BITS = 20, 24
WINDOWS_AT_ONCE = 8192
_CHUNK = 1_500_000

#: ASCII letters and digits stay (lower case), every other ASCII byte parts words.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: str) -> list[bytes]:
    return text.lower().encode().translate(_FOLD).split()


def hashes_of(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), dtype=np.uint32, count=len(words))


def stride_of(n: int) -> int:
    return max(1, n // 4)


class Walk:
    """One CGK embedding for windows of ``m`` words and its sampled positions."""

    def __init__(self, m: int, repetitions: int, seed: int):
        rng = np.random.default_rng([seed, m])
        self.m, self.steps = m, 2 * m
        self.mult = rng.integers(1, 2**32, self.steps, dtype=np.uint32) | np.uint32(1)
        self.plus = rng.integers(0, 2**32, self.steps, dtype=np.uint32)
        k = min(SAMPLE, self.steps)
        self.at: dict[int, list[int]] = {}
        for r in range(repetitions):
            for t in (int(rng.integers(self.steps * j // k, self.steps * (j + 1) // k)) for j in range(k)):  # spread, so few are of one word
                self.at.setdefault(t, []).append(r)
        self.salt = rng.integers(1, 2**63, repetitions, dtype=np.uint64)
        self.last = max(self.at)

    def signatures(self, symbols: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """(repetitions, windows) uint64; ``symbols`` ends with at least ``m`` spare words."""
        sig = np.repeat(self.salt[:, None], len(starts), axis=1)
        at, stop = starts.astype(np.int64), starts + self.m
        prime = np.uint64(0x9E3779B97F4A7C15)
        for t in range(self.last + 1):
            now = symbols[at]
            now[at >= stop] = 0  # past the window's end
            if t in self.at:
                wide = now.astype(np.uint64) + np.uint64(t)
                for r in self.at[t]:
                    sig[r] = (sig[r] ^ wide) * prime
            at += (now * self.mult[t] + self.plus[t]) >> np.uint32(31)
            np.minimum(at, stop, out=at)
        return sig


def most_edits(n: int, share: float) -> int:
    """The edits that an item of ``n`` words may have; the share of 1 - 0.8 is a little under a fifth."""
    return int(share * n + 1e-9)


def known_words(m: int, similarity: float) -> int:
    """Words of a window of ``m`` that have to occur in the items: half as many again as edits may be missing."""
    return m - max(1, int(1.5 * (1 - similarity) * m + 1e-9))


def edited(words: np.ndarray, share: float, rng) -> np.ndarray:
    """``words`` with ``share`` of them replaced, deleted or doubled by new ones."""
    out = list(words)
    for _ in range(most_edits(len(words), share)):
        i, kind = int(rng.integers(len(out))), int(rng.integers(3))
        new = int(rng.integers(1, 2**32))
        out[i:i + 1] = [[new], [], [out[i], new]][kind] if len(out) > 1 else [new]
    return np.array(out, dtype=np.uint32)


class Vocabulary:
    """Which word hashes occur in the items: a bitmap that may say yes too often, never no."""

    def __init__(self, hashes: np.ndarray):
        bits = min(max(16 * len(hashes), 1).bit_length(), FILTER_BITS[1])
        self.shift = np.uint32(32 - bits)
        self.seen = np.zeros(1 << bits, dtype=bool)
        self.seen[hashes >> self.shift] = True

    def known(self, symbols: np.ndarray) -> np.ndarray:
        """Running number of known words before each position."""
        return np.concatenate([[0], np.cumsum(self.seen[symbols >> self.shift])])


def within(known: np.ndarray, starts: np.ndarray, m: int, least: int) -> np.ndarray:
    """The windows with at least ``least`` known words; ``known`` may end before a window does."""
    return starts[known[np.minimum(starts + m, len(known) - 1)] - known[starts] >= least]


def shared(walk: Walk, pairs: list, stride: int, firsts: list, words: Vocabulary, least: int) -> np.ndarray:
    """For each pair (item, edited item) whether they share a signature of ``walk``."""
    def laid(arrays, starts):
        spare = np.zeros(2 * walk.m, dtype=np.uint32)
        at = np.cumsum([0] + [len(a) + len(spare) for a in arrays])
        sig = walk.signatures(np.concatenate([x for a in arrays for x in (a, spare)]),
                              np.concatenate([s + x for s, x in zip(starts, at)]))
        who = np.repeat(np.arange(len(arrays)), [len(s) for s in starts])
        return sig ^ (who.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), who

    own, _ = laid([a for a, _ in pairs], [np.arange(len(a) - walk.m + 1) for a, _ in pairs])
    windows = [within(words.known(b), np.arange(f, max(f + 1, len(b) - walk.m + 1), stride), walk.m, least)
               for (_, b), f in zip(pairs, firsts)]
    found = np.zeros(len(pairs), dtype=bool)
    if not sum(map(len, windows)):
        return found
    near, who = laid([b for _, b in pairs], windows)
    for a, b in zip(own, near):
        found[who[np.isin(b, a)]] = True
    return found


def walks_for(items: list[np.ndarray], m: int, stride: int, similarity: float, target: float, seed: int,
              words: Vocabulary, least: int) -> list[Walk]:
    """Walks until items edited up to the limit are found with probability ``target`` (and a standard error)
    at each of the shortest lengths; an error if more walks find nothing new before that."""
    rng = np.random.default_rng([seed, m, 1])
    simulated = []
    for n in sorted({len(a) for a in items})[:LENGTHS]:
        same = [a for a in items if len(a) == n]
        pairs = [(a, edited(a, 1 - similarity, rng)) for a in (same[k % len(same)] for k in range(SIMULATED))]
        simulated.append((pairs, rng.integers(stride, size=SIMULATED).tolist(), np.zeros(SIMULATED, dtype=bool)))
    walks, rates, idle, short = [], [], 0, True
    while short:
        if idle == STALLED:
            raise ValueError(f"a recall of {target} at similarity {similarity} is out of reach for windows of {m} words: {min(rates):.3f}")
        walks.append(Walk(m, PER_WALK, seed + 7 * len(walks)))
        for pairs, firsts, found in simulated:
            found |= shared(walks[-1], pairs, stride, firsts, words, least)
        before, rates = rates, [found.mean() for _, _, found in simulated]
        idle = idle + 1 if rates == before else 0
        short = any(r - (r * (1 - r) / SIMULATED) ** 0.5 < target for r in rates)
    return walks


def best_match(pattern: list[bytes], text: list[bytes]) -> tuple[int, int]:
    """(distance, end): smallest word edit distance of ``pattern`` to any stretch of ``text``
    and where the first such stretch ends.  Bit-parallel over the pattern."""
    n = len(pattern)
    peq: dict = {}
    for i, w in enumerate(pattern):
        peq[w] = peq.get(w, 0) | (1 << i)
    full, top = (1 << n) - 1, 1 << (n - 1)
    pv, mv, score, best, end = full, 0, n, n, 0
    for j, w in enumerate(text):
        eq = peq.get(w, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (~(xh | pv) & full)
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph, mh = (ph << 1) & full, (mh << 1) & full
        pv = mh | (~(xv | ph) & full)
        mv = ph & xv
        if score < best:
            best, end = score, j + 1
    return best, end


class Index:
    """The signatures of one block of items."""

    def __init__(self, items: list[tuple], similarity: float, target: float, seed: int, min_words: int):
        self.similarity = similarity
        self.items = [(i, w) for i, t in items if len(w := words_of(t or "")) >= min_words]
        self.words = Vocabulary(np.unique(hashes_of([w for _, words in self.items for w in words])))
        order = sorted(range(len(self.items)), key=lambda k: len(self.items[k][1]))
        self.classes = []
        while order:
            n = len(self.items[order[0]][1])
            own = order if n >= ONE_CLASS else [k for k in order if len(self.items[k][1]) < min(ONE_CLASS, max(n + 1, n * RATIO))]
            order = order[len(own):]
            self.classes.append(self._class(n, own, target, seed))

    def _class(self, n: int, own: list[int], target: float, seed: int):
        n = min(n, LONG)
        stride = stride_of(n)
        m = n - 2 * stride + 1
        arrays = {k: hashes_of(self.items[k][1]) for k in own}
        spare, indexed = np.zeros(m, dtype=np.uint32), []
        for least in range(known_words(m, self.similarity), -1, -1):  # fewer where the target is out of reach
            try:
                walks = walks_for(list(arrays.values()), m, stride, self.similarity, target, seed, self.words, least)
                break
            except ValueError:
                if not least:
                    raise
        for walk in walks:
            sigs, who, offs = [], [], []
            for k, a in arrays.items():
                starts = np.arange(len(a) - m + 1, dtype=np.int32)
                s = walk.signatures(np.concatenate([a, spare]), starts)
                sigs.append(s.ravel())
                who.append(np.full(s.size, k, dtype=np.int32))
                offs.append(np.tile(starts, len(s)))
            sig, who, offs = np.concatenate(sigs), np.concatenate(who), np.concatenate(offs)
            by = np.argsort(sig, kind="stable")
            bits = min(max(16 * len(sig) - 1, 1).bit_length(), FILTER_BITS[1])
            shift = np.uint64(64 - max(bits, FILTER_BITS[0]))
            seen = np.zeros(1 << (64 - int(shift)), dtype=bool)
            seen[(sig >> shift).astype(np.int64)] = True
            indexed.append((walk, sig[by], who[by], offs[by], seen, shift))
        return m, stride, least, indexed

    def parts(self) -> dict:
        """The index as plain values, which a broadcast pickles without this package."""
        classes = [(m, stride, least, [(vars(walk), *rest) for walk, *rest in walks]) for m, stride, least, walks in self.classes]
        return vars(self) | {"words": vars(self.words), "classes": classes}

    @classmethod
    def of(cls, parts: dict) -> "Index":
        """The index of these :meth:`parts`, whose arrays it shares."""
        def made(kind, values):
            out = kind.__new__(kind)
            vars(out).update(values)
            return out

        classes = [(m, stride, least, [(made(Walk, walk), *rest) for walk, *rest in walks]) for m, stride, least, walks in parts["classes"]]
        return made(cls, parts | {"words": made(Vocabulary, parts["words"]), "classes": classes})

    def limit(self, n: int) -> int:
        return most_edits(n, 1 - self.similarity)

    def _candidates(self, symbols: np.ndarray, total: int):
        """(item, document word at which the item would begin), without repeats."""
        found, known = set(), self.words.known(symbols)
        for m, stride, least, walks in self.classes:
            likely = within(known, np.arange(0, total, stride), m, least)
            for first in range(0, len(likely), WINDOWS_AT_ONCE):
                starts = likely[first:first + WINDOWS_AT_ONCE]
                for walk, sig, who, offs, seen, shift in walks:
                    rows = walk.signatures(symbols, starts)
                    rep, may = np.nonzero(seen[(rows >> shift).astype(np.int64)])
                    got = rows[rep, may]
                    lo, hi = np.searchsorted(sig, got, "left"), np.searchsorted(sig, got, "right")
                    for i, a, b in zip(may[hi > lo].tolist(), lo[hi > lo].tolist(), hi[hi > lo].tolist()):
                        found.update((int(who[x]), int(starts[i]) - int(offs[x])) for x in range(a, b))
        return found

    def search(self, texts: list[str]) -> list[list[tuple]]:
        """For each text the leaks (item id, edit distance, item words, first word, end word), best per item."""
        words, ends = [], []
        for t in texts:
            words.extend(words_of(t))
            ends.append(len(words))
        best: list[dict] = [{} for _ in texts]
        if not words or not self.classes:
            return [[] for _ in texts]
        spare = np.zeros(2 * max(c[0] for c in self.classes), dtype=np.uint32)
        symbols, ends = np.concatenate([hashes_of(words), spare]), np.array(ends)
        for k, begin in sorted(self._candidates(symbols, len(words))):
            item_id, item = self.items[k]
            n, most = len(item), self.limit(len(item))
            middle = min(max(begin + n // 2, 0), len(words) - 1)
            for d in {int(np.searchsorted(ends, max(begin, 0), "right")), int(np.searchsorted(ends, middle, "right"))}:
                if d >= len(texts):
                    continue
                at, stop = (int(ends[d - 1]) if d else 0), int(ends[d])
                lo, hi = max(at, begin - most - n // 4), min(stop, begin + n + most + n // 4)
                if hi - lo < n - most:
                    continue
                near = set(words[lo:hi])
                if sum(w in near for w in item) < n - most:  # an edit takes away one word at most
                    continue
                dist, end = best_match(item, words[lo:hi])
                if dist > most:
                    continue
                back, length = best_match(item[::-1], words[lo:lo + end][::-1])
                hit = (dist, lo + end - length - at, lo + end - at, item_id, n)
                if k not in best[d] or hit < best[d][k]:
                    best[d][k] = hit
        return [[(h[3], h[0], h[4], h[1], h[2]) for _, h in sorted(b.items())] for b in best]


LEAK = "array<struct<item_id:{},distance:int,item_words:int,first_word:long,end_word:long>>"


def leak_column(text: Column, items: list[tuple], id_type: str, similarity: float, target: float, seed: int,
                min_words: int, spark) -> Column:
    sent = spark.sparkContext.broadcast(Index(items, similarity, target, seed, min_words).parts())

    @F.pandas_udf(LEAK.format(id_type))
    def run(texts: pd.Series) -> pd.Series:
        index, out, batch, size = Index.of(sent.value), [], [], 0  # Spark keeps one value a worker and drops it in the next stage
        for t in texts:
            if batch and size + len(t) > _CHUNK:
                out += index.search(batch)
                batch, size = [], 0
            batch.append(t)
            size += len(t)
        out += index.search(batch)
        return pd.Series([[dict(zip(("item_id", "distance", "item_words", "first_word", "end_word"), h)) for h in hits]
                          for hits in out], dtype=object)

    return run.asNondeterministic()(text)  # else a filter on the leaks, explode's too, searches a second time, in workers of its own


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int):
    """The items in blocks of at most ``block_bytes`` of text (a longer item is a block of its own)."""
    block, size = [], 0
    for r in benchmark.select(F.col(id_col).alias("i"), text_or_empty(text_col).alias("t")).toLocalIterator():
        n = len(r["t"].encode())
        if block and size + n > block_bytes:
            yield block
            block, size = [], 0
        block.append((r["i"], r["t"]))
        size += n
    if block:
        yield block


def with_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id",
               item_text: str = "text", similarity: float = 0.8, target_recall: float = 0.95, seed: int = 11,
               min_words: int = 5, block_bytes: int = 400_000, name: str = "leaks") -> DataFrame:
    """``docs`` with an array column ``name`` of the benchmark items each text holds."""
    kind = benchmark.schema[item_id].dataType.simpleString()
    settings = kind, similarity, target_recall, seed, min_words, docs.sparkSession
    later = item_blocks(benchmark, item_id, item_text, block_bytes)
    first, second = next(later, None), next(later, None)
    if first is None:
        return docs.withColumn(name, F.array().cast(LEAK.format(kind)))
    if second is None:
        return small_batches(docs).withColumn(name, leak_column(text_or_empty(text_col), first, *settings))
    row, of, hit = (fresh(docs, c) for c in ("_leak_row", "_leak_of", "_leak_hits"))
    rows = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "leak-rows")
    found = None
    for block in chain((first, second), later):
        hits = small_batches(rows).select(row, leak_column(text_or_empty(text_col), block, *settings).alias(hit))
        hits = materialize(hits, "leaks").where(F.size(hit) > 0)
        found = hits if found is None else found.unionByName(hits)
    found = found.groupBy(F.col(row).alias(of)).agg(F.flatten(F.collect_list(hit)).alias(hit))
    out = rows.join(found, F.col(row) == F.col(of), "left")
    return out.withColumn(name, F.coalesce(hit, F.array().cast(LEAK.format(kind)))).select(*[c for c in docs.columns if c.lower() != name.lower()], name)


def op5_benchmark_decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = with_leaks(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("leaks").alias("l")).select("doc_id", "l.*")
