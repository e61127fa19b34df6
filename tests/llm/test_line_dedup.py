"""Operator 13 against plain Python, with partitions small enough that hashes span several."""

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stratus.llm import line_dedup as ld

SPACE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_chars=ld.MIN_CHARS, min_docs=ld.MIN_DOCS):
    """Sorted (doc, lines, dropped, sha256) of (doc, text) rows."""
    holders = defaultdict(set)
    split = [(d, (t or "").split("\n")) for d, t in rows]
    for d, lines in split:
        for x in lines:
            holders[x.strip(SPACE).translate(LOWER)].add(d)
    out = []
    for d, lines in split:
        kept = []
        for x in lines:
            key = x.strip(SPACE).translate(LOWER)
            held = holders[key]
            largest = max(held, key=lambda v: (v is not None, v or 0))
            if len(key) < min_chars or len(held) < min_docs or d == largest:
                kept.append(x)
        out.append((d, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r))


def run(docs, **kw):
    rows = ld.drop_lines(docs, ld.keep_bitmaps(docs, **kw))
    got = rows.select("doc_id", ld.n_lines("text").alias("n"), "n_dropped", F.sha2("kept_text", 256).alias("s")).collect()
    return sorted((tuple(r) for r in got), key=lambda r: (r[0] is not None, r[0] or 0, r))


def line(k):
    return f"line number {k} " + "of the text that documents share " * 2


EDGE_ROWS = (
    [(i, line(0) + f"\nown words of {i}\n\t" + line(0).upper() + " \r") for i in range(20)]       # repeated inside, in either case
    + [(100 + i, line(1)) for i in range(4)]                                                      # one document too few
    + [(200 + i, line(2)) for i in range(5)]                                                      # just enough
    + [(300, line(3))] * 6 + [(301 + i, line(3)) for i in range(3)]                               # repeated rows are one document
    + [(None, line(4)), (None, line(5)), (None, None)] + [(400 + i, line(4) + "\n" + line(5)) for i in range(4)]
    + [(500 + i, "x" * 39 + "\n" + "y" * 40 + "\n" + "é" * 39 + "\n" + "é" * 40 + "\nÉ" + "é" * 40) for i in range(6)]
    + [(600, None), (601, ""), (602, "\n\n"), (603, "\n".join(line(k % 7) for k in range(3000)))]
    + [(700 + i, line(6) + " ") for i in range(5)] + [(800 + i, "\x0b" + line(6) + "\x0c") for i in range(5)]
)


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_edges(spark, docs_of, partitions):
    docs = docs_of(spark, [(i, t, "s") for i, t in EDGE_ROWS]).withColumns(
        {c: F.lit("x") for c in ("pos", "h1", "h2", "last", "n_lines", "keep")})
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
        assert run(docs) == brute(EDGE_ROWS)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_clashing_output_names(spark, docs_of):
    docs = docs_of(spark, [(i, line(0), "s") for i in range(6)]).withColumns({"n_dropped": F.lit(7), "kept_text": F.lit("mine")})
    rows = ld.drop_lines(docs, ld.keep_bitmaps(docs))
    assert rows.columns == [*docs.columns, "_n_dropped", "_kept_text"]
    got = rows.orderBy("doc_id").collect()
    assert [r["_n_dropped"] for r in got] == [1, 1, 1, 1, 1, 0]
    assert all(r["n_dropped"] == 7 and r["kept_text"] == "mine" for r in got)


def test_string_ids_and_empty_table(spark):
    rows = [(f"d{i}", line(i % 2)) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    got = {r["doc_id"]: r["n_dropped"] for r in ld.drop_lines(docs, ld.keep_bitmaps(docs)).collect()}
    assert {d for d, n in got.items() if not n} == {"d8", "d9"}  # the largest strings
    none = docs.limit(0)
    assert ld.drop_lines(none, ld.keep_bitmaps(none)).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_stream_over_any_cut(seed):
    """Every cut of the sorted rows into partitions and batches gives the same lines."""
    rng = np.random.default_rng(seed)
    rows = sorted({(int(rng.integers(4)), 0, -int(rng.integers(9)), int(rng.integers(5))) for _ in range(120)})
    want = set()
    for key in {r[0] for r in rows}:
        docs = {r[2] for r in rows if r[0] == key}
        if len(docs) >= 5:
            want |= {r for r in rows if r[0] == key and r[2] != min(docs)}
    cuts = [0, *sorted(rng.integers(0, len(rows), 6).tolist()), len(rows)]
    out, opened, edges = set(), [], []
    for part, (a, b) in enumerate(zip(cuts, cuts[1:])):
        stream, step = ld.Stream(5, part), int(rng.integers(1, 9))
        for i in range(a, b, step):
            x = rows[i:min(b, i + step)]
            stream.add(pa.RecordBatch.from_pydict({"h1": [r[0] for r in x], "h2": [0] * len(x), "doc": [-r[2] for r in x],
                                                   "th": [0] * len(x), "pos": [r[3] for r in x]}))
        stream.end()
        for kind, got in stream.out:
            found = [(r["h1"], 0, -r["doc"], r["pos"]) for r in got.to_pylist()]
            out.update(found) if kind == ld.DROP else opened.extend(found)
        edges += [(part, h1, h2, first, n, last) for h1, h2, n, first, last in stream.edges]
    keepers = {h1: keeper for h1, _, keeper in ld.edge_verdicts(edges, 5)}
    out |= {r for r in opened if r[0] in keepers and -r[2] != keepers[r[0]]}
    assert out == want


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in ld.op13_line_dedup(spark, "/root/testdata/sf0.01").collect())
    assert got == brute(rows)
    assert sum(r[2] for r in got) > 0


def test_query_equals_sql(spark):
    import duckdb
    con = duckdb.connect()
    con.sql("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    got = ld.op13_line_dedup(spark, "/root/testdata/sf0.001")
    assert sorted(map(tuple, got.collect())) == sorted(con.sql(ld.OP13_SQL).select(*got.columns).fetchall())


def test_texts_are_joined_the_same_way_at_every_size(spark, docs_of):
    """A few bitmaps are not broadcast: their join would turn into a shuffle of all texts as the table grows."""
    rows = [(i, line(0), "s") for i in range(6)]
    docs = docs_of(spark, rows)
    marks = spark.range(1).selectExpr("id AS doc", "id AS th", "id AS n_dropped", "cast('x' AS binary) AS keep")
    plan = ld.drop_lines(docs, marks)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert run(docs) == brute([r[:2] for r in rows])
