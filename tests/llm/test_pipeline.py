"""The pipeline's stages and run() against plain Python on a small fixture with planted cases."""

import os
import random
import re
import sys
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402

VOCAB = [a + b + c for a in ("ka", "lo", "mi", "ne", "pu", "ra") for b in ("to", "sha", "ve", "gri", "dun") for c in ("l", "n", "s", "x", "")]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
KEY = "aB3dE5fG7h9Kq"


def _fixture():
    rng = random.Random(21)
    prose = lambda n: " ".join(rng.choice(VOCAB) for _ in range(n))
    items = [(k, prose(n)) for k, n in enumerate((5, 9, 20, 40))] + [(9, None), (10, "")]
    rows = []
    for i in range(60):
        rows.append((i, "\n".join(prose(15) for _ in range(4)), "b" if i % 3 else "a"))
    banner = "Subscribe to the letter of week {} and never miss a word again"
    for i in range(100, 130):  # a line that 30 texts of a host hold, numbers apart; five of them hold little else
        rows.append((i, banner.format(i) + "\n" + prose(12 if i < 105 else 60), "a"))
    base = prose(120)
    rows += [(200, base, "b"), (201, base, "c"), (202, base, None), (199, base, "b")]
    rows += [(300 + k, prose(40) + " " + t + " " + prose(40), "c") for k, t in items if t]
    changed = items[3][1].split()
    changed[7] = "other"
    rows.append((310, prose(50) + " " + " ".join(changed) + " " + prose(20), "c"))
    rows += [(400, prose(40) + f'\nprivate_key = "{KEY}"\n' + prose(40), "c"), (401, prose(40) + f"\npassword: {KEY}9\n", "c")]
    rows += [(500, None, "a"), (501, "", "a"), (502, "few words only", "b"), (503, " ".join(["again and again we say it"] * 20), "b")]
    rows += [(None, prose(50), None), (600, prose(3000), "b"), (601, prose(50), "b"), (601, rows[0][1], "b")]
    rows += [rows[5], rows[5]]
    rng.shuffle(rows)
    return items, [(i, t, "xx", h, None if t is None else len(t)) for i, t, h in rows]


def _words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t)


def _quality(rows):
    norm = lambda line: re.sub("[0-9]+", "0", " ".join(_words(line.lower())))
    hosts, held = {}, Counter()
    for _, t, _, h, _ in rows:
        hosts.setdefault(h, set()).add(t or "")
    for h, texts in hosts.items():
        for t in texts:
            held.update({(h, norm(x)) for x in t.split("\n") if _words(x)})
    gone = {k for k, n in held.items() if n > 20 or (n > 5 and n > len(hosts[k[0]]) * 0.1)}
    out = []
    for i, t, lang, h, n in rows:
        w = _words(t or "")
        grams = Counter(tuple(w[p:p + 8]) for p in range(len(w) - 7))
        covered = {p + k for p in range(len(w) - 7) if grams[tuple(w[p:p + 8])] > 1 for k in range(8)}
        rest = [x for x in (t or "").split("\n") if (h, norm(x)) not in gone]
        left = len(_words("\n".join(rest)))
        if len(w) < 20 or 100 * len(covered) > 30 * len(w) or (left < len(w) and (left < 20 or 2 * left < len(w))):
            continue
        text = "\n".join(rest)
        out.append((i, text, lang, h, len(text) if text != t else n))
    return out


def _print(t):
    w = _words(re.sub("[A-Z]", lambda m: m.group().lower(), t))
    grams = [" ".join(w[p:p + 3]) for p in range(len(w) - 2)] or [" ".join(w)] * bool(w)
    hs = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def _one_of_each(rows):
    """(smallest id of each class); NULL ids come first."""
    prints = [_print(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                root[find(a)] = find(b)
    groups = {}
    for k, r in enumerate(rows):
        groups.setdefault(find(k), []).append(r)
    return list(groups.values())


def _holds(text, item):
    """Whether a stretch of the text is within a word in five of the item (edits of words)."""
    t, m = text.lower().split(), item.lower().split()
    row = list(range(len(m) + 1))
    best = row[-1]
    for w in t:
        new = [0]
        for k, x in enumerate(m):
            new.append(min(row[k] + (w != x), row[k + 1] + 1, new[k] + 1))
        row = new
        best = min(best, row[-1])
    return best <= int(len(m) * 0.2 + 1e-9)


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    where = str(tmp_path_factory.mktemp("sf"))
    items, rows = _fixture()
    docs = spark.createDataFrame(rows, SCHEMA)
    docs.write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{where}/benchmark.parquet")
    return where, items, rows


def _rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_quality_stage(spark, world):
    where, _, rows = world
    got = corpus_pipeline.quality_stage(spark, spark.createDataFrame(rows, SCHEMA), where)
    want = _quality(rows)
    assert _rows(got) == Counter(want)
    ids = {r[0] for r in want}
    assert not ids & {100, 101, 102, 103, 104, 500, 501, 502, 503} and {110, 129, 600, None} <= ids
    assert not any("Subscribe" in r[1] for r in want)


def test_stages_compute_a_text_once(spark, world):
    """A second Python step in a stage doubles its time and the Python workers that an executor keeps."""
    where, _, rows = world
    docs = spark.createDataFrame(rows, SCHEMA)
    for stage in (corpus_pipeline.quality_stage, corpus_pipeline.decontamination_stage, corpus_pipeline.secrets_stage):
        plan = stage(spark, docs, where)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1


def test_near_duplicate_stage(spark, world):
    where, _, rows = world
    rows = _quality(rows)
    got = corpus_pipeline.near_duplicate_stage(spark, spark.createDataFrame(rows, SCHEMA), where).collect()
    groups = _one_of_each(rows)
    assert len(got) == len(groups) and {199} <= {r.doc_id for r in got} and not {200, 201, 202} & {r.doc_id for r in got}
    low = lambda r: (r[0] is not None, r[0] or 0)
    assert Counter(r.doc_id for r in got) == Counter(min(g, key=low)[0] for g in groups)


def test_decontamination_stage(spark, world):
    where, items, rows = world
    rows = [r for r in rows if r[1] is not None]
    got = _rows(corpus_pipeline.decontamination_stage(spark, spark.createDataFrame(rows, SCHEMA), where))
    want = Counter(r for r in rows if not any(t and _holds(r[1], t) for _, t in items))
    assert got == want and not {300, 301, 302, 303, 310} & {r[0] for r in want}


def test_secrets_stage(spark, world):
    where, _, rows = world
    got = _rows(corpus_pipeline.secrets_stage(spark, spark.createDataFrame(rows, SCHEMA), where))
    want = Counter()
    for i, t, lang, h, n in rows:
        if i == 400:
            t = t.replace(KEY, "<SECRET>")
        if i == 401:
            t = t.replace(f"password: {KEY}9", "<SECRET>")
        want[(i, t, lang, h, len(t) if i in (400, 401) else n)] += 1
    assert got == want


def test_run(spark, world):
    where, items, rows = world
    got = corpus_pipeline.run(spark, where).collect()
    kept = [min(g, key=lambda r: (r[0] is not None, r[0] or 0))[0] for g in _one_of_each(_quality(rows))]
    leaked = {r[0] for r in _quality(rows) if any(t and _holds(r[1], t) for _, t in items)}
    assert {r["doc_id"] for r in got} == set(kept) - leaked
    places = {}
    for r in got:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for p in places.values():
        at = 0
        for offset, length in sorted(p):
            assert offset == at
            at += length
        assert at <= 1024
    assert len([r for r in got if r["doc_id"] == 600]) > 3


def test_clashing_columns_and_empty_tables(spark, world):
    where, _, rows = world
    names = ("quality", "leaks", "_found", "found", "_row", "_host_key", "_facts", "spans")
    docs = spark.createDataFrame(rows, SCHEMA).drop("n_chars").withColumns({c: F.lit(f"my {c}") for c in names})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, where)
        assert out.columns == docs.columns
        assert [tuple(r) for r in out.select(*names).distinct().collect()] == [tuple(f"my {c}" for c in names)]
        assert stage(spark, docs.limit(0), where).collect() == []
    assert corpus_pipeline.packing_stage(spark, docs.limit(0), where).collect() == []
