"""Second-order gradient boosting over binned features, with level-wise and best-first growth.

Plan.  Features are cut at quantiles into at most 256 bins.  The rows are packed once into blocks (bins feature by
feature, label, weight, margin), one table row per ``BLOCK`` observations, written to the checkpoint folder.  Every
histogram is one job: each task adds up gradient and hessian sums by (node, feature, bin) of its blocks, and the
partial sums are shuffled by feature and added there.  What reaches the driver is (nodes x features x bins x 2)
doubles, a size that the settings fix, whatever the rows.  Only the smaller child of a split is summed; its sibling
is the parent less that child.

Growth.  ``leaves=None`` grows level by level, one histogram job a level.  With ``leaves`` set the leaf of the largest
gain is split next (a priority queue), and one job fetches the histograms of all leaves that may still be split,
so a tree takes about as many jobs as it has levels and its splits are those of one-by-one growth.

Each tree draws its own rows (by block, from seed and tree) and its own columns.  A leaf's value is
-G / (H + l2) times the rate; a split's gain is GL^2/(HL+l2) + GR^2/(HR+l2) - G^2/(H+l2).  Rows below a threshold go
left; NaN and NULL go right.  Trees grown since the last fold are applied to the rows on the fly; every ``FOLD``
trees the margins are written anew, which cuts lineage, so a lost executor re-reads at most that.
"""

from __future__ import annotations

import heapq
import json
import sys
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.materialize import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need no copy of this package

BINS = 256
BLOCK = 65_536
FOLD = 20
_LEAST_HESSIAN = 1e-16


@dataclass
class BoostConfig:
    """Settings of one model.  ``leaves``: best-first growth up to so many leaves, else level-wise."""
    rounds: int = 300
    depth: int = 6
    rate: float = 0.05
    subsample: float = 0.8
    colsample: float = 0.8
    l2: float = 1.0
    min_hessian: float = 1.0
    leaves: int | None = None
    objective: str = "squared"   # or "logistic"
    seed: int = 42


@dataclass
class Tree:
    """Nodes by number; a leaf has feature -1 and points at itself."""
    feature: list = field(default_factory=list)
    cut: list = field(default_factory=list)
    threshold: list = field(default_factory=list)
    left: list = field(default_factory=list)
    right: list = field(default_factory=list)
    value: list = field(default_factory=list)
    gain: list = field(default_factory=list)

    def add(self, value: float) -> int:
        k = len(self.feature)
        for column, x in zip((self.feature, self.cut, self.threshold, self.left, self.right, self.value, self.gain),
                             (-1, 0, 0.0, k, k, value, 0.0)):
            column.append(x)
        return k


def route(tree: Tree, depth: int, goes_right) -> np.ndarray:
    """The node of each row; ``goes_right(feature, node)`` tells by row, for rows at an inner node."""
    feature, left, right = (np.array(x) for x in (tree.feature, tree.left, tree.right))
    node = None
    for _ in range(depth):
        node = np.zeros(1, dtype=np.int64) if node is None else node
        f = feature[node]
        node = np.where(f < 0, node, np.where(goes_right(np.maximum(f, 0), node), right[node], left[node]))
    return node


def nodes_of_bins(tree: Tree, bins: np.ndarray, depth: int) -> np.ndarray:
    cut, rows = np.array(tree.cut), np.arange(bins.shape[1])
    node = route(tree, depth, lambda f, node: bins[f, rows] > cut[node])
    return np.broadcast_to(node, (bins.shape[1],))


def nodes_of_values(tree: Tree, values: np.ndarray, depth: int) -> np.ndarray:
    threshold, rows = np.array(tree.threshold), np.arange(len(values))
    node = route(tree, depth, lambda f, node: ~(values[rows, f] < threshold[node]))
    return np.broadcast_to(node, (len(values),))


def gradients(objective: str, margin: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if objective == "squared":
        return w * (margin - y), w
    p = 1.0 / (1.0 + np.exp(-margin))
    return w * (p - y), np.maximum(w * p * (1.0 - p), _LEAST_HESSIAN)


def drawn(seed: int, tree: int, block: int, n: int, share: float) -> np.ndarray:
    """The rows of a block that a tree sees."""
    return np.random.default_rng([seed, tree, block]).random(n) < share if share < 1 else np.ones(n, dtype=bool)


def columns_of(seed: int, tree: int, n: int, share: float) -> list[int]:
    """The features that a tree sees."""
    if share >= 1:
        return list(range(n))
    return sorted(np.random.default_rng([seed, tree]).choice(n, max(1, int(share * n)), replace=False).tolist())


def best_split(hist: np.ndarray, columns: list[int], cuts: list[int], l2: float, min_hessian: float):
    """(gain, feature, cut, (GL, HL), (GR, HR)) of the largest gain, the first feature and cut on ties; None without gain.

    ``hist``: (column, bin, 2) sums; feature f has ``cuts[f]`` cuts.
    """
    total = hist[0].sum(axis=0)
    below = np.cumsum(hist, axis=1)[:, :-1]
    above = total - below
    fit = (below[..., 1] >= min_hessian) & (above[..., 1] >= min_hessian)
    fit &= np.arange(below.shape[1]) < np.array([cuts[f] for f in columns])[:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = below[..., 0] ** 2 / (below[..., 1] + l2) + above[..., 0] ** 2 / (above[..., 1] + l2)
    gain = np.where(fit, gain - total[0] ** 2 / (total[1] + l2), -np.inf)
    at = int(gain.argmax())
    k, b = divmod(at, gain.shape[1])
    if not gain[k, b] > 1e-12:
        return None
    return float(gain[k, b]), columns[k], b, tuple(map(float, below[k, b])), tuple(map(float, above[k, b]))


def grow(histograms, columns: list[int], cuts: list[np.ndarray], cfg: BoostConfig) -> Tree:
    """One tree.  ``histograms(tree, nodes)`` gives the (column, bin, 2) sums of the rows at each of ``nodes``."""
    tree, counts = Tree(), [len(c) for c in cuts]
    root = histograms(tree_with_root(tree), [0])[0]
    sums, depth, held, split = {0: tuple(map(float, root[0].sum(axis=0)))}, {0: 0}, {0: root}, {}
    opened: list = []
    kept: set = set()

    def offer(k):
        if depth[k] < cfg.depth and k in held:
            split[k] = best_split(held[k], columns, counts, cfg.l2, cfg.min_hessian)
            if split[k]:
                heapq.heappush(opened, ((depth[k], k) if cfg.leaves is None else (-split[k][0], k)))

    def expand(nodes):
        """Children of ``nodes``, and their histograms where they may be split again."""
        small = []
        for k in nodes:
            _, f, b, low, high = split[k]
            left, right = tree.add(0.0), tree.add(0.0)
            tree.feature[k], tree.cut[k], tree.threshold[k] = f, b, float(cuts[f][b])
            tree.left[k], tree.right[k], tree.gain[k] = left, right, split[k][0]
            for c, s in ((left, low), (right, high)):
                sums[c], depth[c] = s, depth[k] + 1
            if depth[left] < cfg.depth:
                small.append((left, right, k) if low[1] <= high[1] else (right, left, k))
        if small:
            for (a, other, k), h in zip(small, histograms(tree, [a for a, _, _ in small])):
                held[a], held[other] = h, held[k] - h

    offer(0)
    leaves = 1
    while opened and (cfg.leaves is None or leaves < cfg.leaves):
        if tree.feature[opened[0][1]] < 0:
            ahead = [k for _, k in (opened if cfg.leaves is None else heapq.nsmallest(cfg.leaves - leaves, opened))]
            level = depth[opened[0][1]]
            expand([k for k in ahead if tree.feature[k] < 0 and (cfg.leaves is not None or depth[k] == level)])
        k = heapq.heappop(opened)[1]
        kept.add(k)
        leaves += 1
        held.pop(k)
        for c in (tree.left[k], tree.right[k]):
            offer(c)
    return pruned(tree, kept, sums, cfg)


def tree_with_root(tree: Tree) -> Tree:
    tree.add(0.0)
    return tree


def pruned(tree: Tree, kept: set, sums: dict, cfg: BoostConfig) -> Tree:
    """The splits that were taken, renumbered in breadth-first order, with the leaves' values."""
    out, queue = Tree(), [0]
    out.add(0.0)
    for new, old in enumerate(queue):
        g, h = sums[old]
        out.value[new] = -g / (h + cfg.l2) * cfg.rate
        if old in kept:
            out.feature[new], out.cut[new], out.threshold[new] = tree.feature[old], tree.cut[old], tree.threshold[old]
            out.gain[new] = tree.gain[old]
            out.left[new], out.right[new] = out.add(0.0), out.add(0.0)
            queue += [tree.left[old], tree.right[old]]
    return out


def cut_points(data: DataFrame, features: list[str], bins: int = BINS) -> list[np.ndarray]:
    """Up to ``bins`` - 1 increasing cuts a feature, at its quantiles, by one mergeable sketch each
    (within 1 / (4 * bins) of the rank, exact for small tables).  A value below all others is no cut."""
    x = data.select(*[F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(f"x{k}") for k, c in enumerate(features)])
    found = x.approxQuantile(x.columns, [i / bins for i in range(bins)], 1 / (4 * bins))
    return [q[q > q[0]] if len(q) else q for q in (np.unique(np.array(f, dtype=np.float64)) for f in found)]


def blocks(data: DataFrame, features: list[str], label: str, weight: str | None, cuts: list[np.ndarray], base: float) -> DataFrame:
    """(block, n, bins, y, w, margin): packed rows of ``data``, written once.  Rows without a label take no part."""
    src = data.where(F.col(label).isNotNull()).select(
        F.col(label).cast("double").alias("y"), (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w"),
        F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in features]).alias("x"))
    width = len(features)

    def run(batches):
        part, k, held, rows = TaskContext.get().partitionId(), 0, [], 0

        def packed():
            y, w, x = (np.concatenate(p) for p in zip(*held))
            bins = np.empty((width, len(y)), dtype=np.uint8)
            for f in range(width):
                bins[f] = np.searchsorted(cuts[f], x[:, f], side="right")
            return pa.RecordBatch.from_pydict(
                {"block": [(part << 24) + k], "n": [len(y)], "bins": [bins.tobytes()], "y": [y.tobytes()], "w": [w.tobytes()],
                 "margin": [np.full(len(y), base).tobytes()]}, schema)

        schema = pa.schema([("block", pa.int64()), ("n", pa.int64()), *((c, pa.binary()) for c in ("bins", "y", "w", "margin"))])
        for batch in batches:
            if batch.num_rows:
                held.append((batch["y"].to_numpy(), batch["w"].to_numpy(), batch["x"].flatten().to_numpy().reshape(-1, width)))
                rows += batch.num_rows
                if rows >= BLOCK:
                    yield packed()
                    held, rows, k = [], 0, k + 1
        if held:
            yield packed()

    return materialize(src.mapInArrow(run, "block long, n long, bins binary, y binary, w binary, margin binary"), "boost-blocks")


def opened_blocks(batches):
    """(block, n, bins, y, w, margin) of each packed row, without copies."""
    for batch in batches:
        for block, n, bins, y, w, m in zip(*(batch[c].to_pylist() for c in ("block", "n", "bins", "y", "w", "margin"))):
            y, w, m = (np.frombuffer(x, dtype=np.float64) for x in (y, w, m))
            yield block, n, np.frombuffer(bins, dtype=np.uint8).reshape(-1, n), y, w, m


def margins(margin: np.ndarray, bins: np.ndarray, trees: list[Tree], depth: int) -> np.ndarray:
    for t in trees:
        margin = margin + np.array(t.value)[nodes_of_bins(t, bins, depth)]
    return margin


def level_histograms(rows: DataFrame, recent: list[Tree], number: int, columns: list[int], cfg: BoostConfig):
    """The function that :func:`grow` asks for sums, over the blocks ``rows``."""

    def partial(tree, nodes):
        def run(batches):
            slot = np.full(len(tree.feature), len(nodes))
            slot[nodes] = np.arange(len(nodes))
            width, out = len(nodes) * BINS, None
            for block, n, bins, y, w, margin in opened_blocks(batches):
                rows_in = np.flatnonzero(drawn(cfg.seed, number, block, n, cfg.subsample))
                at = slot[nodes_of_bins(tree, bins, cfg.depth)][rows_in]
                g, h = gradients(cfg.objective, margins(margin, bins, recent, cfg.depth), y, w)
                here = at < len(nodes)
                rows_in, at = rows_in[here], at[here] * BINS
                g, h = g[rows_in], h[rows_in]
                out = np.zeros((len(columns), width, 2)) if out is None else out
                for i, f in enumerate(columns):
                    key = at + bins[f, rows_in]
                    out[i, :, 0] += np.bincount(key, weights=g, minlength=width)
                    out[i, :, 1] += np.bincount(key, weights=h, minlength=width)
            if out is not None:
                yield pa.RecordBatch.from_pydict({"f": pa.array(range(len(columns)), pa.int32()), "hist": [x.tobytes() for x in out]})
        return run

    def added(table: pa.Table) -> pa.Table:
        # the order of the partial sums may differ between runs; the last bits of a sum may too
        total = sum(np.frombuffer(x, dtype=np.float64) for x in table["hist"].to_pylist())
        return pa.table({"f": table["f"].slice(0, 1), "hist": pa.array([total.tobytes()], pa.binary())})

    def histograms(tree: Tree, nodes: list[int]) -> list[np.ndarray]:
        sums = rows.mapInArrow(partial(tree, nodes), "f int, hist binary").groupBy("f").applyInArrow(added, "f int, hist binary").collect()
        out = np.zeros((len(columns), len(nodes), BINS, 2))
        for r in sums:
            out[r["f"]] = np.frombuffer(bytes(r["hist"]), dtype=np.float64).reshape(len(nodes), BINS, 2)
        return [out[:, k] for k in range(len(nodes))]

    return histograms


def with_margins(rows: DataFrame, trees: list[Tree], depth: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            new = [margins(m, bins, trees, depth).tobytes() for _, _, bins, _, _, m in opened_blocks([batch])]
            yield batch.set_column(batch.schema.get_field_index("margin"), "margin", pa.array(new, pa.binary()))

    return materialize(rows.mapInArrow(run, rows.schema), "boost-blocks")


@dataclass
class BoostedModel:
    features: list
    cfg: BoostConfig
    base: float
    trees: list
    prediction: str = "prediction"
    probability: str | None = None

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with the predicted value, or for a logistic model the class and the probability of class 1."""
        trees, base, depth = self.trees, self.base, self.cfg.depth

        @F.pandas_udf("double")
        def margin(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype="float64")
            values = np.stack(x.to_numpy()).astype(np.float64)
            out = np.full(len(values), base)
            for t in trees:
                out += np.array(t.value)[nodes_of_values(t, values, depth)]
            return pd.Series(out)

        m = margin(F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in self.features]))
        if self.cfg.objective == "squared":
            return df.withColumn(self.prediction, m)
        df = df.withColumn(self.probability, 1.0 / (1.0 + F.exp(-m)))
        return df.withColumn(self.prediction, (F.col(self.probability) > 0.5).cast("double"))

    def importances(self) -> list[float]:
        """Average gain of each feature's splits, as shares of their sum."""
        gain, n = np.zeros(len(self.features)), np.zeros(len(self.features))
        for t in self.trees:
            for f, g in zip(t.feature, t.gain):
                if f >= 0:
                    gain[f] += g
                    n[f] += 1
        mean = gain / np.maximum(n, 1)
        return (mean / (mean.sum() or 1.0)).tolist()

    def save(self, spark, path: str) -> None:
        text = json.dumps({**asdict(self), "trees": [asdict(t) for t in self.trees]})
        spark.createDataFrame([(text,)], "model string").coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark, path: str) -> "BoostedModel":
        d = json.loads(spark.read.parquet(path).first()["model"])
        return BoostedModel(d["features"], BoostConfig(**d["cfg"]), d["base"], [Tree(**t) for t in d["trees"]], d["prediction"],
                            d["probability"])


def base_margin(data: DataFrame, label: str, cfg: BoostConfig) -> float:
    """Where boosting begins: the label's mean, or its log odds (unweighted) for a logistic model."""
    mean = data.agg(F.avg(F.col(label).cast("double"))).first()[0]
    if mean is None:
        raise ValueError(f"no rows with a {label}")
    if cfg.objective == "squared":
        return float(mean)
    share = min(max(mean, 1e-6), 1 - 1e-6)
    return float(np.log(share / (1 - share)))


def root_splits(data: DataFrame, features, label: str, cfg: BoostConfig) -> DataFrame:
    """(feature, threshold, gain, left_hessian): the best first split of every feature in round 1, all rows and columns."""
    features, spark = list(features), data.sparkSession
    cfg = replace(cfg, subsample=1.0, colsample=1.0)
    cuts = cut_points(data, features)
    rows, every = blocks(data, features, label, None, cuts, base_margin(data, label, cfg)), list(range(len(features)))
    hist = level_histograms(rows, [], 0, every, cfg)(tree_with_root(Tree()), [0])[0]
    found = [(f, best_split(hist[f:f + 1], [f], [len(c) for c in cuts], cfg.l2, cfg.min_hessian)) for f in every]
    return spark.createDataFrame([(features[f], float(cuts[f][s[2]]), s[0], s[3][1]) for f, s in found if s],
                                 "feature string, threshold double, gain double, left_hessian double")


def fit(data: DataFrame, features, label: str, cfg: BoostConfig, weight: str | None = None, prediction: str = "prediction",
        probability: str | None = None, cuts: list[np.ndarray] | None = None) -> BoostedModel:
    """Boosts ``cfg.rounds`` trees.  ``cuts``: those of :func:`cut_points`, to share them between models of the same rows."""
    features = list(features)
    base = base_margin(data, label, cfg)
    cuts = cut_points(data, features) if cuts is None else cuts
    rows = blocks(data, features, label, weight, cuts, base).persist(StorageLevel.MEMORY_AND_DISK)
    model = BoostedModel(features, cfg, base, [], prediction, probability)
    folded = 0
    for number in range(cfg.rounds):
        columns = columns_of(cfg.seed, number, len(features), cfg.colsample)
        model.trees.append(grow(level_histograms(rows, model.trees[folded:], number, columns, cfg), columns, cuts, cfg))
        if number + 1 - folded == FOLD and number + 1 < cfg.rounds:
            again = with_margins(rows, model.trees[folded:], cfg.depth).persist(StorageLevel.MEMORY_AND_DISK)
            rows.unpersist()
            rows, folded = again, number + 1
    rows.unpersist()
    return model
