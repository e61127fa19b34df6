"""Operator 12: hard negatives by maximum inner product search with LEMP-style coordinate pruning.

Every row is ranked by its integer inner product with each anchor.  An anchor's positives are its
first rows of the same label; for each positive the first rows of other labels whose score lies
between two shares of the positive's are its hard negatives.

Method.  The rows lie in buckets of similar length, longest first.  With the score that an anchor
still has to reach (``at least``), a bucket whose longest row is ``long`` asks for a cosine of
t = at_least / (|anchor| * long): above 1 the bucket and all after it are left out.  Otherwise a
row's normalised coordinate f must lie in the feasible range q_f * t -+ sqrt((1 - q_f^2) (1 - t^2));
for the anchor's largest coordinates (``FOCUS``) the range is looked up in the bucket's sorted
coordinate list, the row sets are intersected, and what is left is scored exactly.  Every bucket
raises the score to reach; it begins with what a bounded sample of rows guarantees, which speeds
the search and never changes its result.  Equal scores are kept until ties are broken by id.

Scale.  The anchors are a stated query set that meets all rows in blocks: the rows are cut into
groups of at most ``group_rows`` by length, every anchor is sent to every group, and a task reads one
group, then streams the anchors past it.  A group returns at most ``negatives`` rows for an anchor's
positive, so a very common vector or label adds no rows to a shuffle.  The result is the best of the
groups, by window rank.

Defined results: rows with a NULL id or label, a NULL vector, or any NULL or non-finite component
take no part; vectors of another dimension than the anchor's are no candidates; an anchor without a
positive, or whose positive's score is negative, has no rows (then no score lies in between); repeated
rows are rows of their own, equal ones count as often as they occur and each is an anchor; an empty
table gives no rows; other columns do not matter, whatever their names.  A score beyond 64 bits is an error.
"""

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.materialize import materialize
from .common import ship, table, worker_object

ship(__name__)

FOCUS = 3
BUCKET = 2048
GROUP_ROWS, SMALL_GROUP = 32_768, 1024
#: Rows of the sample whose scores give each anchor its first score to reach.
SAMPLE = 2048
_EXACT = float(2**53)
_SLACK = 1e-9


class Bucket:
    """Rows of similar length with a sorted list for each coordinate."""

    def __init__(self, ids, rows, labels, vectors: np.ndarray):
        self.ids, self.rows, self.labels = ids, rows, labels
        self.whole = vectors
        self.vectors = vectors.astype(np.float64)
        lengths = np.sqrt((self.vectors ** 2).sum(axis=1))
        self.longest, self.size = float(lengths.max(initial=0.0)), np.abs(self.vectors).max(initial=0.0)
        self.unit = self.vectors / np.where(lengths > 0, lengths, 1.0)[:, None]
        self.shortest = float(lengths.min()) if len(lengths) else 0.0
        self.order = np.argsort(self.unit, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.unit, self.order, axis=0)

    def candidates(self, unit: np.ndarray, focus: np.ndarray, cosine: float) -> np.ndarray | slice:
        """Rows whose focus coordinates allow ``cosine``; all of them where nothing can be told."""
        if cosine <= 0 or self.shortest == 0 or not len(focus):
            return slice(None)
        t, q = min(cosine, 1.0), unit[focus]
        spread = np.sqrt(np.maximum(0.0, (1 - q * q) * (1 - t * t))) + _SLACK
        low, high = q * t - spread, q * t + spread
        a = [int(np.searchsorted(self.sorted[:, f], x, "left")) for f, x in zip(focus, low)]
        b = [int(np.searchsorted(self.sorted[:, f], x, "right")) for f, x in zip(focus, high)]
        least = min(range(len(focus)), key=lambda k: b[k] - a[k])
        rows = self.order[a[least]:b[least], focus[least]]
        for k, f in enumerate(focus):  # membership in another list's range, by value
            if k != least:
                at = self.unit[rows, f]
                rows = rows[(at >= low[k]) & (at <= high[k])]
        return rows

    def scores(self, rows, anchor: "Anchor") -> np.ndarray:
        if self.size * anchor.size * max(1, self.vectors.shape[1]) < _EXACT:
            return (self.vectors[rows] @ anchor.vector).astype(np.int64)
        return np.array([sum(map(int.__mul__, map(int, v), anchor.whole)) for v in self.whole[rows]], dtype=object)


class Anchor:
    def __init__(self, vector: list[int]):
        self.whole = vector
        self.vector = np.array(vector, dtype=np.float64)
        self.size = float(np.abs(self.vector).max(initial=0.0))
        self.length = float(np.sqrt((self.vector ** 2).sum()))
        self.unit = self.vector / (self.length or 1.0)
        self.focus = np.argsort(-np.abs(self.unit), kind="stable")[:FOCUS] if self.length else np.array([], dtype=int)


class Best:
    """The first ``k`` (score, id) of those offered between two scores."""

    def __init__(self, k: int, low, high):
        self.k, self.reach, self.high = k, low, high
        self.scores, self.ids = np.array([], dtype=np.int64), np.array([], dtype=np.int64)

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        fit = np.ones(len(scores), dtype=bool)
        if self.reach is not None:
            fit &= scores >= self.reach
        if self.high is not None:
            fit &= scores <= self.high
        if not fit.any():
            return
        scores, ids = np.concatenate([self.scores, scores[fit]]), np.concatenate([self.ids, ids[fit]])
        if len(scores) > 4 * self.k:  # the k-th score, then all that reach it
            fit = scores >= np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            scores, ids = scores[fit], ids[fit]
        by = sorted(range(len(scores)), key=lambda i: (-scores[i], ids[i])) if scores.dtype == object else np.lexsort((ids, -scores))
        self.scores, self.ids = scores[by[:self.k]], ids[by[:self.k]]
        if len(self.scores) == self.k:
            self.reach = int(self.scores[-1])


def buckets_of(ids, rows, labels, vectors: list) -> dict[int, list[Bucket]]:
    """Buckets by dimension, longest rows first."""
    out = {}
    sizes = np.array([len(v) for v in vectors])
    for d in np.unique(sizes):
        own = np.flatnonzero(sizes == d)
        m = np.array([vectors[i] for i in own], dtype=np.int64).reshape(len(own), d)
        own_order = np.argsort(-(m.astype(np.float64) ** 2).sum(axis=1), kind="stable")
        own, m = own[own_order], m[own_order]
        out[int(d)] = [Bucket(ids[own[i:i + BUCKET]], rows[own[i:i + BUCKET]], labels[own[i:i + BUCKET]], m[i:i + BUCKET])
                       for i in range(0, len(own), BUCKET)]
    return out


def search(buckets: dict[int, list[Bucket]], anchor: Anchor, row: int, label, same: bool, wanted: list[Best]) -> None:
    """Offers to each of ``wanted`` the rows (same label: others than ``row``) that can still reach it."""
    for bucket in buckets.get(len(anchor.whole), ()):
        reach = None if any(w.reach is None for w in wanted) else min(w.reach for w in wanted)
        most = anchor.length * bucket.longest
        cosine = -1.0 if reach is None else reach / most if most else 0.0
        if cosine > 1 + _SLACK:
            return  # the rows only get shorter
        rows = bucket.candidates(anchor.unit, anchor.focus, cosine)
        labels = bucket.labels[rows]
        keep = (labels == label) & (bucket.rows[rows] != row) if same else labels != label
        rows = np.arange(len(bucket.ids))[rows][keep]
        if len(rows):
            scores = bucket.scores(rows, anchor)
            for w in wanted:
                w.offer(scores, bucket.ids[rows])


def negative_range(score: int, low: int, high: int) -> tuple[int, int]:
    """Whole scores s with low * score <= 100 * s <= high * score."""
    return -(-low * score // 100), high * score // 100


def in_groups(vectors: DataFrame, anchors: DataFrame, groups: int, schema: str, work) -> DataFrame:
    """``work(buckets, anchor batch)`` for every group of ``vectors`` and all ``anchors``.

    A task sorts its rows so that a group's vectors come before the anchors.
    """
    sent = anchors.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).withColumn("asks", F.lit(True))
    extra = [c for c in anchors.columns if c not in vectors.columns]
    mine = vectors.withColumns({c: F.lit(None).cast(anchors.schema[c].dataType) for c in extra}).withColumn("asks", F.lit(False))
    rows = mine.unionByName(sent).repartition(groups, "grp").sortWithinPartitions("grp", "asks")

    def run(batches):
        group, held, buckets = None, [], None
        for batch in batches:
            for (grp, asks), part in batch.groupby(["grp", "asks"], sort=False):
                if grp != group:
                    group, held, buckets = grp, [], None
                if not asks:
                    held.append(part[["id", "row", "label", "v"]])
                    continue
                if buckets is None:
                    own = pd.concat(held) if held else part.iloc[:0]
                    held = []
                    buckets = buckets_of(own["id"].to_numpy(np.int64), own["row"].to_numpy(np.int64), label_array(own["label"].tolist()),
                                         list(own["v"]))
                yield work(buckets, part)

    return rows.mapInPandas(run, schema)


def sample_of(vectors: DataFrame):
    """(key, broadcast of the plain values) of ``SAMPLE`` rows, chosen by hash."""
    rows = vectors.orderBy(F.xxhash64("row"), "row").limit(SAMPLE).select("id", "row", "label", "v").collect()
    return uuid.uuid4().hex, vectors.sparkSession.sparkContext.broadcast([tuple(r) for r in rows])


def opened(sample) -> dict[int, list[Bucket]]:
    """The sample's buckets, built once a worker process."""
    def build():
        ids, rows, labels, vectors = zip(*sample[1].value) if sample[1].value else ([],) * 4
        return buckets_of(np.array(ids, dtype=np.int64), np.array(rows, dtype=np.int64), label_array(labels), list(vectors))

    return worker_object(("negatives-sample", sample[0]), build)


def label_array(labels) -> np.ndarray:
    out = np.empty(len(labels), dtype=object)
    out[:] = labels
    return out


def positive_finder(sample, k: int):
    """Every anchor's best ``k`` of a group's rows of its label; the sample only says which score they must reach."""

    def work(buckets, anchors: pd.DataFrame) -> pd.DataFrame:
        out, rows = [], opened(sample)
        for a in anchors.itertuples():
            q, known, best = Anchor([int(x) for x in a.v]), Best(k, None, None), Best(k, None, None)
            search(rows, q, a.row, a.label, True, [known])
            best.reach = known.reach
            search(buckets, q, a.row, a.label, True, [best])
            out += [(a.row, i, s) for s, i in zip(best.scores.tolist(), best.ids.tolist())]
        return pd.DataFrame(out, columns=["row", "positive_id", "positive_score"])

    return work


def negative_finder(sample, k: int, low: int, high: int):

    def work(buckets, anchors: pd.DataFrame) -> pd.DataFrame:
        out, rows = [], opened(sample)
        for a in anchors.itertuples():
            q = Anchor([int(x) for x in a.v])
            scores = [int(p) for p in a.scores]
            known = {s: Best(k, *negative_range(s, low, high)) for s in scores if s >= 0}
            if not known:
                continue
            search(rows, q, a.row, a.label, False, list(known.values()))
            best = {}
            for s, seen in known.items():
                best[s] = Best(k, *negative_range(s, low, high))
                best[s].reach = seen.reach
            search(buckets, q, a.row, a.label, False, list(best.values()))
            for n, s in enumerate(scores):
                if s in best:
                    out += [(a.row, n, i, x) for x, i in zip(best[s].scores.tolist(), best[s].ids.tolist())]
        return pd.DataFrame(out, columns=["row", "nth", "negative_id", "negative_score"])

    return work


def whole_vectors(rows: DataFrame, id_col: str, vector_col: str, label: str, scale: int) -> DataFrame:
    """(id, row, label, v, length2) of the rows that take part; v holds floor(scale * x)."""
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    v = F.transform(x, lambda c: F.floor(c * scale).cast("long"))
    length2 = F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c)
    return (rows.where(F.col(id_col).isNotNull() & F.col(label).isNotNull() & F.col(vector_col).isNotNull() & fine)
            .select(F.col(id_col).cast("long").alias("id"), F.monotonically_increasing_id().alias("row"),
                    F.col(label).alias("label"), v.alias("v")).withColumn("length2", length2))


def hard_negatives(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                   every: int = 100, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
                   scale: int = 256, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each row whose id is divisible
    by ``every`` and each of its ``positives`` best rows of the same label, the ``negatives`` best rows of other labels
    that score ``low`` to ``high`` percent of the positive."""
    spark = rows.sparkSession
    flat = materialize(whole_vectors(rows, id_col, vector_col, label_col, scale), "vectors")
    n = flat.count()
    groups = max(-(-n // group_rows), min(spark.sparkContext.defaultParallelism, -(-n // SMALL_GROUP)), 1)
    vectors = materialize(flat.repartitionByRange(groups, F.col("length2").desc(), "row").drop("length2")
                          .withColumn("grp", F.spark_partition_id()), "vector-groups")
    groups = max(groups, (vectors.agg(F.max("grp")).first()[0] or 0) + 1)
    sample = sample_of(vectors)
    anchors = vectors.where(F.col("id") % every == 0).select("id", "row", "label", "v")
    best = Window.partitionBy("row").orderBy(F.desc("positive_score"), "positive_id")
    found = in_groups(vectors, anchors, groups, "row long, positive_id long, positive_score long",
                      positive_finder(sample, positives))
    chosen = (found.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= positives)
              .groupBy("row").agg(F.array_sort(F.collect_list(F.struct("nth", "positive_id", "positive_score"))).alias("chosen")))
    asked = materialize(anchors.join(chosen, "row"), "anchors")
    sent = asked.withColumn("scores", F.col("chosen.positive_score")).select("id", "row", "label", "v", "scores")
    found = in_groups(vectors, sent, groups, "row long, nth int, negative_id long, negative_score long",
                      negative_finder(sample, negatives, low, high))
    first = Window.partitionBy("row", "nth").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= negatives)
    pairs = asked.select("row", F.col("id").alias("anchor_id"), F.posexplode("chosen").alias("nth", "p"))
    return pairs.join(ranked, ["row", "nth"]).select("anchor_id", "p.positive_id", "rank", "negative_id", "p.positive_score",
                                                     "negative_score")


def op12_hard_negatives(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved))


OP12_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same,
         CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
 AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY rank <= 10
"""
