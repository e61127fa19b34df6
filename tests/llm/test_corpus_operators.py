"""Operators over the whole corpus: brute force, exactness, held-out accuracy, the pipeline."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratus.llm import components, packing, quality, simhash, toxicity
from stratus.llm.common import table

SF = "/root/testdata/sf0.001"

SF_LARGER = "/root/testdata/sf0.01"


def _roots(n, pairs):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


@pytest.mark.parametrize("shape", ["path", "star", "random", "empty"])
def test_components_match_union_find(spark, shape):
    rng = random.Random(7)
    n = 60
    pairs = {"path": [(i, i + 1) for i in range(n - 1)], "star": [(30, i) for i in range(n) if i != 30],
             "random": [(rng.randrange(n), rng.randrange(n)) for _ in range(40)], "empty": []}[shape]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    roots = _roots(n, pairs)
    assert got == {x: roots[x] for p in pairs for x in p}


def _slow_fingerprint(text, k=3):
    import xxhash
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text)) if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_match_the_definition(spark):
    texts = ["", " ", "One", "one two", "One TWO three four four four four", "Ünïcode ÀB c\x85d e\xa0f", "a b c " * 50]
    for t in texts:
        assert simhash.fingerprint(t) & (2**64 - 1) == _slow_fingerprint(t)
    # the same hash as the engine's own function
    h = spark.sql("select xxhash64('one two') h").first()["h"]
    import xxhash
    assert h & (2**64 - 1) == xxhash.xxh64_intdigest(b"one two", 42)


@pytest.mark.parametrize("bucket", [1, 3, 1000])
@pytest.mark.parametrize("max_bits", [1, 3])
def test_near_pairs_lose_none_at_any_bucket_size(spark, bucket, max_bits):
    rng = random.Random(8)
    prints = {rng.getrandbits(64) for _ in range(40)}
    for centre in list(prints)[:3]:  # dense clusters around a few fingerprints
        for _ in range(40):
            x = centre
            for _ in range(rng.randrange(5)):
                x ^= 1 << rng.randrange(64)
            prints.add(x)
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    want = {(min(a, b), max(a, b)) for i, a in enumerate(signed) for b in signed[i + 1:] if ((a ^ b) & (2**64 - 1)).bit_count() <= max_bits}
    found = simhash.near_pairs(spark.createDataFrame([(p,) for p in signed], "fp long"), max_bits, bucket).collect()
    assert {(r["a"], r["b"]) for r in found} == want and len(found) == len(want)


@pytest.mark.parametrize("bucket, max_bits", [(1, 1), (1000, 3)])
def test_signatures_are_never_broadcast(spark, bucket, max_bits):
    """Their size is told as that of the rows before the explode, below the limit of a broadcast for millions of rows."""
    rows = spark.range(40).select(F.col("id").alias("fp"))
    found = simhash.near_pairs(rows, max_bits, bucket)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    want = {(a, b) for b in range(40) for a in range(b) if (a ^ b).bit_count() <= max_bits}
    assert sorted(map(tuple, found.collect())) == sorted(want)


def test_pairs_are_joined_to_their_ends_without_a_broadcast(spark, monkeypatch):
    plans, write = {}, simhash.materialize

    def watched(df, label):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, label)

    monkeypatch.setattr(simhash, "materialize", watched)
    prints = write(spark.range(8).select((20 - F.col("id")).alias("doc"), F.col("id").alias("th"), F.col("id").alias("fp")), "prints")
    got = {r["fp"]: r["root"]["doc"] for r in simhash.classes(prints, 1, 128).collect()}
    assert got == dict.fromkeys(range(8), 13)
    assert plans["ends"].count("SortMergeJoin") == 2 and "BroadcastHashJoin" not in plans["ends"]


def test_near_duplicates_match_brute_force(spark):
    docs = table(spark, SF, "documents")
    rows = docs.select("doc_id", "text").collect()
    prints = [_slow_fingerprint(r["text"] or "") for r in rows]
    order = sorted(range(len(rows)), key=lambda i: rows[i]["doc_id"])
    pairs = [(x, y) for x in range(len(order)) for y in range(x + 1, len(order))
             if (prints[order[x]] ^ prints[order[y]]).bit_count() <= 3]
    roots = _roots(len(order), pairs)
    want = {rows[order[x]]["doc_id"]: (f"{prints[order[x]]:016x}", rows[order[roots[x]]]["doc_id"]) for x in range(len(order))}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()}
    assert got == want
    kept = {r["doc_id"] for r in simhash.drop_near_duplicates(docs).collect()}
    assert kept == {d for d, (_, c) in want.items() if c == d}


def test_near_duplicates_odd_rows(spark, docs_of):
    rows = [(5, "a b c d", "s"), (5, "a b c d", "s"), (3, "a b c d", "s"), (None, "a b c d", "s"), (9, None, "s"), (8, "", "s"), (None, "other words here", None)]
    docs = docs_of(spark, rows)
    got = [(r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()]
    assert sorted(got, key=str) == sorted([(5, 3), (5, 3), (3, 3), (None, 3), (9, 8), (8, 8), (None, None)], key=str)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [3, 8, None]
    assert simhash.near_duplicates(docs.limit(0)).collect() == []


# ---- packing ----------------------------------------------------------------

def test_ids_equal_those_of_the_tokenizer(spark):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(packing.vocabulary("byte_bpe_50k.json"))
    ids = packing.Ids(packing.TOKENIZERS)
    texts = [r["text"] or "" for r in table(spark, SF, "documents").select("text").collect()]
    texts += ["", " ", "  a \n b", "<|endoftext|>", "x <|endoftext|> y", "\n <|endoftext|>z", "é ñ 😀", "a\x1cb ²³ ½"]
    for x, e in zip(texts, t.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(ids.encode(x), dtype="<u4").tolist() == e.ids


def test_knapsack_matches_brute_force():
    rng = random.Random(9)
    for _ in range(40):
        cap = rng.randrange(3, 14)
        value = np.array([0.0] + [rng.choice([0, rng.random()]) for _ in range(cap)])
        best = [0.0] * (cap + 1)
        for c in range(1, cap + 1):
            best[c] = max([best[c - 1]] + [best[c - k] + value[k] for k in range(1, c + 1)])
        conf = packing.best_configuration(value, cap)
        assert sum(k * a for k, a in conf.items()) <= cap
        assert sum(value[k] * a for k, a in conf.items()) == pytest.approx(best[cap])


def test_plan_holds_every_piece_and_is_near_the_bound():
    rng = random.Random(10)
    for cap in (8, 64, 1024):
        for many in (1, 3000):
            hist = {}
            for _ in range(400):
                k = rng.randrange(1, cap + 1)
                hist[k] = hist.get(k, 0) + rng.randrange(1, many + 1)
            rows = packing.plan(hist, cap)
            held = {}
            for conf, times in rows:
                assert times > 0 and sum(k * a for k, a in conf) <= cap
                for k, a in conf:
                    held[k] = held.get(k, 0) + a * times
            assert held == hist
            bound = max(-(-sum(k * n for k, n in hist.items()) // cap), sum(n for k, n in hist.items() if 2 * k > cap))
            assert sum(t for _, t in rows) <= bound * 1.05 + 3


def _histogram(sf):
    import pyarrow.parquet as pq
    ids, hist = packing.Ids(packing.TOKENIZERS), {}
    for t in pq.read_table(f"{sf}/documents.parquet", columns=["text"])["text"].to_pylist():
        for _, k in packing.cut(len(ids.encode(t or "")) // 4 + 1, 1024):
            hist[k] = hist.get(k, 0) + 1
    return hist


def test_plan_comes_from_the_linear_program():
    # most sequences that the greedy filling alone, the whole ones aside, needed on these tables
    for sf, greedy, share in (("/root/testdata/sf0.01", 456, 0.45), ("/root/testdata/sf0.1", 4465, 0.85)):
        hist = _histogram(sf)
        need = np.array([0] + [hist.get(k, 0) for k in range(1, 1024)] + [0])
        x, bound = packing.multiplicative_weights(need, 1024)
        held = np.zeros(1025)
        for conf, v in x.items():
            assert v > 0 and sum(k * a for k, a in conf) <= 1024
            for k, a in conf:
                held[k] += a * v
        assert np.allclose(held, need)                                # every length is covered, none twice
        assert bound >= (need @ np.arange(1025)) / 1024 - 1e-6 and sum(x.values()) <= 1.01 * bound
        rows = packing.plan({k: v for k, v in hist.items() if k < 1024}, 1024)
        assert packing.sequences(rows) <= greedy
        ways = [packing.rounded(x, need, 1024, s, c) for s in packing.SCALES for c in (False, True)]
        of_lp = [w[0] for w in ways if w[0] + w[1] == rows]          # without what best fit placed in the same way
        assert of_lp and max(map(packing.sequences, of_lp)) >= share * greedy


def test_bound_of_the_linear_program():
    # lengths over half the capacity need a sequence each, two of 500 fit in one; 8 + 4 and 5 + 4 + 3 fill one exactly
    for hist, value in (({600: 7}, 7), ({600: 7, 500: 5}, 10), ({8: 9, 4: 9}, 9), ({5: 4, 4: 4, 3: 8}, 5)):
        cap = 12 if max(hist) < 12 else 1024
        need = np.array([hist.get(k, 0) for k in range(cap + 1)])
        x, bound = packing.multiplicative_weights(need, cap)
        assert bound <= value + 1e-9 and bound - 1e-9 <= sum(x.values()) <= value + 1e-9
        assert sum(t for _, t in packing.plan(hist, cap)) == value


def test_packing_is_gapless_and_complete(spark, docs_of):
    docs = table(spark, SF_LARGER, "documents")
    rows = packing.pack(docs).collect()
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    ids, total = packing.Ids(packing.TOKENIZERS), 0
    for d in docs.select("doc_id", "text").collect():
        raw = ids.encode(d["text"] or "") + (2).to_bytes(4, "little")
        got = sorted(by_doc[d["doc_id"]], key=lambda r: r["piece"])
        assert [r["piece"] for r in got] == list(range(len(got))) and sum(r["length"] for r in got) * 4 == len(raw)
        at = 0
        for k, r in enumerate(got):
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(raw[4 * at:4 * (at + r["length"])])
            assert len(got) == 1 or r["length"] == 1024 or k == 0
            at += r["length"]
        total += at
    for s in by_seq.values():
        at = 0
        for r in sorted(s, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
    assert len(by_seq) <= -(-total // 1024) * 1.02 + 1
    odd = docs_of(spark, [(1, None, "a"), (1, "", "a"), (None, "x", None), (2, "word " * 3000, "a")])
    got = packing.pack(odd).collect()
    assert sorted(r["length"] for r in got if r["doc_id"] == 1) == [1, 1]
    assert [r["length"] for r in sorted(got, key=lambda r: r["piece"]) if r["doc_id"] == 2][1:] == [1024, 1024]
    assert packing.pack(odd.limit(0)).collect() == []


# ---- classifiers ------------------------------------------------------------

def test_toxicity_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "labels").select("doc_id", "toxic")
    out = toxicity.classify(docs, labels).join(labels, "doc_id").where("held_out")
    r = out.agg(*[F.count_if(F.expr(e)).alias(n) for n, e in (
        ("pos", "toxic = 1"), ("tp", "toxic = 1 and predicted = 1"), ("fp", "toxic = 0 and predicted = 1"), ("neg", "toxic = 0"))]).first()
    print(r)
    assert r["fp"] <= 0.01 * r["neg"]
    assert r["tp"] >= 0.6 * r["pos"]


def test_counterfactual_penalty_lowers_the_score_of_neutral_mentions(spark):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(60)]
    rows, labels = [], []
    for i in range(1500):
        toxic = rng.random() < .3
        body = [rng.choice(words) for _ in range(15)]
        if toxic and rng.random() < .85:
            body.append("idiot")
        if rng.random() < (.5 if toxic else .05):  # the group is named mostly in toxic texts
            body.append("muslim")
        rows.append((i, " ".join(body)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    probe = spark.createDataFrame([(1, "w1 w2 muslim w3"), (2, "w1 w2 christian w3"), (3, "w1 idiot w3")], "doc_id long, text string")
    def scores(weight):
        w, b = toxicity.train(docs, known, "doc_id", "text", "toxic", 5000, 1e-3, weight)
        col = toxicity.score_column(F.col("text"), w, b, spark)
        return {r["doc_id"]: r["s"] for r in probe.select("doc_id", col.alias("s")).collect()}
    free, fair = scores(0.0), scores(5.0)
    assert fair[1] - fair[2] < 0.3 * (free[1] - free[2])
    assert fair[1] < free[1] and fair[3] > 0.5


def test_label_model_recovers_accuracies():
    rng = np.random.default_rng(12)
    good = np.array([.9, .8, .7, .85, .75])
    bad = np.array([.8, .9, .6, .7, .8])
    y = rng.random(40_000) < .7
    right = np.where(y[:, None], rng.random((40_000, 5)) < good, rng.random((40_000, 5)) < bad)
    vote = np.where(right == y[:, None], "+", "-")
    vote = np.where(rng.random(vote.shape) < .2, "0", vote)
    keys, n = np.unique(["".join(v) for v in vote], return_counts=True)
    m = quality.label_model(dict(zip(keys.tolist(), n.tolist())))
    assert abs(m["prior"] - .7) < .03 and np.abs(np.array(m["good"]) - good).max() < .04 and np.abs(np.array(m["bad"]) - bad).max() < .06


def test_quality_scores_separate_labelled_junk(spark):
    sf = "/root/testdata/sf0.1"
    docs = quality.classify(table(spark, sf, "documents").select("doc_id", "text")).select("doc_id", "quality.score", "quality.kept")
    rows = docs.join(table(spark, sf, "labels").select("doc_id", F.col("quality").alias("y")), "doc_id").toPandas()
    s, y = rows["score"].to_numpy(), rows["y"].to_numpy()
    order = s.argsort().argsort()
    auc = (order[y == 1].sum() - (y == 1).sum() * ((y == 1).sum() - 1) / 2) / ((y == 1).sum() * (y == 0).sum())
    print("auc", auc, "kept good", rows["kept"][y == 1].mean(), "kept bad", rows["kept"][y == 0].mean())
    assert auc > 0.8 and rows["kept"][y == 1].mean() > 0.95
