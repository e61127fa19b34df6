"""Operator 2: counterfactual-regularised toxicity classifier.

A logistic model over the hashed words of a text.  In the labelled texts every
sentence with identity terms gets twins in which the terms are swapped for
others of their group; the squared change of the score between a sentence and
its twins is part of the loss, so that naming a group does not move the score.

Scale.  The fit sees at most ``sample_rows`` labelled rows, those of smallest
id hash (a bounded, documented sample); features are computed on the
executors, the driver gets packed ids.  Scoring is one pass over all rows and
whole texts.

Defined results: a NULL or empty text gets the model's intercept as score; a
NULL doc_id is held out; labels of an id that occurs more than once count as
toxic if any is; repeated documents are scored each; without labels of both
classes every text gets the prior; an empty table gives no rows; extra columns
are ignored.
"""

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, small_batches, table, text_or_empty
from .linear import DIMENSIONS, fit, hashed, score

ship(__name__)

SAMPLE_ROWS = 12_000
L1 = 2e-4
PAIR_WEIGHT = 1.0

#: Identity terms by group (fixed values); a term is swapped for the others of its group.
IDENTITY = (
    ("man", "woman", "transgender"), ("men", "women"), ("male", "female"), ("boy", "girl"), ("he", "she"), ("his", "her"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"), ("christians", "muslims", "jews", "hindus", "atheists"),
    ("black", "white", "asian", "latino", "arab"), ("african", "european", "american", "mexican", "chinese", "indian"),
    ("gay", "straight", "lesbian", "bisexual"), ("immigrant", "citizen", "refugee"), ("immigrants", "citizens", "refugees"),
    ("young", "old"), ("deaf", "blind", "disabled"),
)
SWAPS = {t.encode(): [o.encode() for o in g if o != t] for g in IDENTITY for t in g}
SENTENCE = re.compile(r"[.!?\n]+")
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: str) -> list[bytes]:
    return text.lower().encode().translate(_FOLD).split()


def twins(text: str) -> dict[tuple, int]:
    """How often each swap (terms out, terms in) occurs over the sentences of ``text``."""
    out: dict[tuple, int] = {}
    for sentence in SENTENCE.split(text):
        words = set(words_of(sentence))
        terms = [w for w in words if w in SWAPS]
        for k in range(max((len(SWAPS[t]) for t in terms), default=0)):
            new = {t: SWAPS[t][k % len(SWAPS[t])] for t in terms}
            twin = (words - set(terms)) | set(new.values())
            key = (tuple(sorted(words - twin)), tuple(sorted(twin - words)))
            out[key] = out.get(key, 0) + 1
    return out


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample_rows: int,
          l1: float, pair_weight: float):
    """(weights, intercept) learnt from labelled rows that are not held out."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col))
    sample = (known.groupBy(F.col(id_col).alias("k")).agg(F.max(F.col(label_col).cast("int")).alias("y"))
              .orderBy(F.xxhash64("k"), "k").limit(sample_rows))

    @F.pandas_udf("ids binary, swaps array<struct<out:array<binary>,into:array<binary>,n:int>>")
    def features(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({
            "ids": [hashed(set(words_of(t))).tobytes() for t in texts],
            "swaps": [[{"out": list(a), "into": list(b), "n": n} for (a, b), n in twins(t).items()] for t in texts]})

    joined = docs.select(F.col(id_col).alias("k"), text_or_empty(text_col).alias("t")).join(F.broadcast(sample), "k")
    rows = (joined.select("k", "y", F.xxhash64("k", "t").alias("h"), features("t").alias("f"))
            .orderBy("h", "k").limit(sample_rows).select("y", "f.ids", "f.swaps").collect())
    pairs: dict[tuple, int] = {}
    for r in rows:
        for s in r["swaps"]:
            key = (tuple(map(bytes, s["out"])), tuple(map(bytes, s["into"])))
            pairs[key] = pairs.get(key, 0) + s["n"]
    changes = [(hashed(a), hashed(b), n) for (a, b), n in sorted(pairs.items())]
    return fit([np.frombuffer(r["ids"], dtype=np.int32) for r in rows], np.array([float(r["y"]) for r in rows]), l1,
               changes, pair_weight)


def score_column(text: Column, weights: np.ndarray, bias: float, spark) -> Column:
    used = np.flatnonzero(weights).astype(np.int32)
    model = spark.sparkContext.broadcast((used, weights[used], bias))

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        ids, values, b = model.value
        full = np.zeros(DIMENSIONS)
        full[ids] = values
        return pd.Series([score(full, b, hashed(set(words_of(t)))) for t in texts], dtype="float64")

    return run(text)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
             sample_rows: int = SAMPLE_ROWS, l1: float = L1, pair_weight: float = PAIR_WEIGHT) -> DataFrame:
    """``docs`` with held_out, score and predicted."""
    small_batches(docs)
    weights, bias = train(docs, labels, id_col, text_col, label_col, sample_rows, l1, pair_weight)
    scored = docs.withColumns({"held_out": held_out(id_col),
                               "score": score_column(text_or_empty(text_col), weights, bias, docs.sparkSession)})
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def op2_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return classify(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic")).select(
        "doc_id", "held_out", "score", "predicted")
