"""Operator 10: quality classifier from weak labels.

Heuristic labellers look at a text and vote good, bad or abstain; they overlap
and disagree.  Expectation-maximisation over the counts of vote patterns
estimates each labeller's accuracy on good and on bad texts and the share of
good texts, without any true label.  The posterior of a text's pattern is its
weak label, and a linear model over hashed text features is fitted to the
weak labels; its score generalises beyond the labellers.

Scale.  Vote patterns are counted over all documents by a partial aggregate;
at most 3^labellers counts reach the driver.  The scorer is fitted on at most
``sample_rows`` distinct texts of smallest hash (a documented bound), and scores
every whole text in one pass.

Defined results: a NULL text is empty; the empty text is scored like any
other; repeated rows get equal scores; an empty table gives no rows; ties
(a posterior or score of exactly one half) count as good; extra columns are
ignored.
"""

import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, small_batches, table, text_or_empty
from .linear import DIMENSIONS, fit, hashed, score

ship(__name__)

SAMPLE_ROWS = 12_000
L1 = 2e-4
SYMBOLS = re.compile(r"[#*$%&|<>]")
END = re.compile(r"[.!?:;\"')\]]\s*$")


LETTERS = re.compile(r"[^\W\d_]+")


def facts(text: str) -> dict:
    words = text.split()
    lines = [x.strip() for x in text.split("\n") if x.strip()]
    n, solid = max(1, len(words)), max(1, sum(map(len, words)))
    counts, pairs = Counter(words), set(zip(words, words[1:]))
    return {"n": len(words), "length": solid / n, "symbols": len(SYMBOLS.findall(text)) / n,
            "dup_lines": 1 - len(set(lines)) / max(1, len(lines)), "lines": len(lines),
            "ended": sum(bool(END.search(x[-3:])) for x in lines) / max(1, len(lines)),
            "letters": sum(map(len, LETTERS.findall(text))) / solid, "distinct": len(counts) / n,
            "short": sum(c for w, c in counts.items() if len(w) <= 3) / n,
            "repeats": 1 - len(pairs) / max(1, len(words) - 1), "top": max(counts.values(), default=0) / n}


def votes(f: dict) -> str:
    """One character a labeller: '+' good, '-' bad, '0' abstains."""
    def rule(good, bad):
        return "-" if bad else "+" if good else "0"

    return "".join((
        rule(f["n"] >= 50, f["n"] < 20),
        rule(3 <= f["length"] <= 9, f["n"] > 0 and not 2 <= f["length"] <= 12),
        rule(f["symbols"] < 0.02, f["symbols"] > 0.15),
        rule(f["lines"] >= 3 and f["dup_lines"] < 0.05, f["dup_lines"] > 0.3),
        rule(f["ended"] >= 0.6, f["lines"] > 0 and f["ended"] < 0.25),
        rule(f["letters"] >= 0.9, f["letters"] < 0.75),
        rule(f["short"] >= 0.15, f["n"] >= 20 and f["short"] < 0.05),
        rule(f["n"] >= 20 and f["repeats"] < 0.35, f["repeats"] > 0.6),
        rule(f["n"] >= 20 and f["top"] < 0.15, f["n"] >= 20 and f["top"] > 0.25),
    ))


def label_model(patterns: dict[str, int], rounds: int = 200) -> dict:
    """EM over vote patterns: prior, accuracies on good and on bad texts, posterior of each pattern.

    Labellers start better than chance, which fixes which of the two classes is 'good'.  A
    labeller's abstention tells nothing; accuracies are smoothed and kept above one half in sum.
    """
    keys = sorted(patterns)
    if not keys:
        return {"prior": 0.5, "good": [], "bad": [], "posterior": {}}
    v = np.array([[{"+": 1, "-": -1, "0": 0}[c] for c in k] for k in keys])
    count = np.array([patterns[k] for k in keys], dtype=float)
    prior, good, bad = 0.8, np.full(v.shape[1], 0.8), np.full(v.shape[1], 0.7)
    for _ in range(rounds):
        log_good = np.log(prior) + ((v == 1) * np.log(good) + (v == -1) * np.log(1 - good)).sum(1)
        log_bad = np.log(1 - prior) + ((v == -1) * np.log(bad) + (v == 1) * np.log(1 - bad)).sum(1)
        post = 1 / (1 + np.exp(np.clip(log_bad - log_good, -50, 50)))
        g, b = count * post, count * (1 - post)
        new_prior = float(np.clip(g.sum() / count.sum(), 0.02, 0.98))
        new_good = (g @ (v == 1) + 4) / (g @ (v != 0) + 5)
        new_bad = (b @ (v == -1) + 3) / (b @ (v != 0) + 5)
        done = abs(new_prior - prior) + np.abs(new_good - good).sum() + np.abs(new_bad - bad).sum() < 1e-9
        prior, good, bad = new_prior, new_good, new_bad
        if done:
            break
    return {"prior": prior, "good": good.tolist(), "bad": bad.tolist(), "posterior": dict(zip(keys, post.tolist()))}


def features(text: str, f: dict) -> np.ndarray:
    """Hashed features: buckets of the text's facts, and the shapes of its words with their shares."""
    out = [f"{k}:{int(min(v, 1) * 20)}".encode() for k, v in f.items() if k not in ("n", "length", "lines")]
    out += [f"n:{f['n'].bit_length()}".encode(), f"len:{int(f['length'])}".encode(), f"lines:{f['lines'].bit_length()}".encode()]
    shapes = Counter(LETTERS.sub("a", text).split())
    n = max(1, f["n"])
    out += [f"shape:{s[:6]}:{int(10 * c / n)}".encode() for s, c in shapes.items()]
    return hashed(out)


def facts_column(text: Column) -> Column:
    @F.pandas_udf("votes string, ids binary")
    def run(texts: pd.Series) -> pd.DataFrame:
        both = [(f := facts(t), features(t, f)) for t in texts]
        return pd.DataFrame([(votes(f), ids.tobytes()) for f, ids in both], columns=["votes", "ids"])

    return run(text)


def votes_column(text: Column) -> Column:
    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([votes(facts(t)) for t in texts], dtype=object)

    return run(text)


def classify(docs: DataFrame, text_col: str = "text", sample_rows: int = SAMPLE_ROWS, l1: float = L1) -> DataFrame:
    """``docs`` with weak_label (posterior that the text is good), score and kept (score >= 1/2)."""
    spark, text = small_batches(docs).sparkSession, text_or_empty(text_col)
    counts = docs.select(votes_column(text).alias("v")).groupBy("v").agg(F.count(F.lit(1)).alias("n")).collect()
    model = label_model({r["v"]: r["n"] for r in counts})
    hashed_texts = docs.select(F.xxhash64(text).alias("h"), text.alias("t"))
    last = hashed_texts.select("h").distinct().orderBy("h").limit(sample_rows).agg(F.max("h")).first()[0]
    texts = hashed_texts.where(F.col("h") <= F.lit(last)).groupBy("h").agg(F.first("t").alias("t"))
    rows = texts.select(facts_column(F.col("t")).alias("f")).select("f.*").collect()
    target = np.array([model["posterior"][r["votes"]] for r in rows])
    weights, bias = fit([np.frombuffer(r["ids"], dtype=np.int32) for r in rows], target, l1)
    used = np.flatnonzero(weights).astype(np.int32)
    sent = spark.sparkContext.broadcast((used, weights[used], bias, model["posterior"]))

    @F.pandas_udf("weak_label double, score double")
    def run(batch: pd.Series) -> pd.DataFrame:
        ids, values, b, posterior = sent.value
        full = np.zeros(DIMENSIONS)
        full[ids] = values
        both = [(f := facts(t), features(t, f)) for t in batch]
        return pd.DataFrame([(posterior[votes(f)], score(full, b, x)) for f, x in both],
                            columns=["weak_label", "score"], dtype="float64")

    scored = docs.withColumn("quality", run(text))
    q = F.col("quality")
    return scored.withColumn("quality", F.struct(q["weak_label"].alias("weak_label"), q["score"].alias("score"),
                                                 (q["score"] >= 0.5).alias("kept")))


def op10_quality_classifier(spark, sf_dir):
    docs = classify(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "quality.weak_label", "quality.score", "quality.kept")
