"""Operator 5 over whole tables: exhaustive search, items in several blocks, workers without this package."""

import os
import pickle
import subprocess
import sys

import numpy as np
from pyspark.sql import functions as F

from stratus.llm import decontaminate as dc

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_query_equals_exhaustive_search(spark):
    """Every item against every whole text of sf0.001, by the edit distance alone."""
    sf = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], dc.words_of(r["text"] or "")) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r["item_id"], dc.words_of(r["text"] or "")) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = set()
    for d, text in docs:
        held = set(text)
        for i, item in items:
            most = dc.most_edits(len(item), 0.2)
            if sum(w in held for w in item) >= len(item) - most and dc.best_match(item, text)[0] <= most:
                want.add((d, i))
    got = [(r["doc_id"], r["item_id"]) for r in dc.op5_benchmark_decontamination(spark, sf).collect()]
    assert len(got) == len(set(got)) and set(got) <= want
    assert want and len(got) >= 0.95 * len(want)


def test_blocks_of_items_give_the_same_leaks(spark):
    rows = [(i, " ".join(f"w{(7 * i + j) % 90}" for j in range(60))) for i in range(40)] + [(40, None), (41, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("l", "_leak_row", "_leak_hits")})
    bench = spark.createDataFrame([(k, " ".join(f"w{(11 * k + j) % 90}" for j in range(20 + k))) for k in range(6)],
                                  "item_id long, text string")

    def found(**kw):
        out = dc.with_leaks(docs, bench, **kw)
        assert out.columns == [*docs.columns, "leaks"]
        return sorted((r["doc_id"], sorted(tuple(x) for x in r["leaks"])) for r in out.collect())

    one = found()
    assert any(x for _, x in one) and found(block_bytes=1) == one


def test_a_worker_holds_the_index_once():
    """The broadcast is read without this package, and the index made of it copies no array."""
    items = [(k, " ".join(f"w{(11 * k + j) % 90}" for j in range(8 + 6 * k))) for k in range(6)]
    index = dc.Index(items, 0.8, 0.95, 11, 5)
    sent = pickle.dumps(index.parts())
    assert b"stratus" not in sent
    parts = pickle.loads(sent)
    made = dc.Index.of(parts)
    texts = [f"before {t} after" for _, t in items] + ["", "none of them"]
    assert made.search(texts) == index.search(texts) and any(made.search(texts))
    assert np.shares_memory(made.words.seen, parts["words"]["seen"])
    for (_, _, _, walks), (_, _, _, given) in zip(made.classes, parts["classes"]):
        for (walk, *arrays, _), (values, *own, _) in zip(walks, given):
            assert all(np.shares_memory(a, b) for a, b in zip(arrays, own)) and walk.mult is values["mult"]


def test_texts_are_searched_once(spark):
    """The query's filter on the leaks must not search every text a second time."""
    df = dc.op5_benchmark_decontamination(spark, "/root/testdata/sf0.001")
    assert df._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from stratus.session import build_session
from stratus.llm.catalog import QUERIES
spark = build_session("local[2]", 4)
def imported(rows):
    import importlib.util
    yield importlib.util.find_spec("stratus") is not None
assert not spark.sparkContext.parallelize([1], 1).mapPartitions(imported).first(), "workers see the package"
for name in ("op5_benchmark_decontamination", "op11_cross_tokenizer_alignment", "op12_hard_negatives", "op13_line_dedup"):
    print(name, QUERIES[name](spark, "/root/testdata/sf0.001").count(), flush=True)
spark.stop()
"""


def test_workers_need_no_copy_of_the_package(tmp_path):
    script = tmp_path / "job.py"
    script.write_text(SCRIPT.format(root=ROOT))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-3000:]
    assert len(done.stdout.split()) == 8
