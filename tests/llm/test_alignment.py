"""Operator 11 against plain Python over the two libraries."""

import hashlib
import json
from collections import Counter

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from stratus.llm import alignment as al

public_tokenizers = pytest.importorskip("public_tokenizers")
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def token_bytes():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    shown = {}
    spare = 0x100
    for b in range(256):  # bytes that Latin-1 does not print are written as U+0100 and following
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b:
            shown[chr(b)] = b
        else:
            shown[chr(spare)] = b
            spare += 1
    return {i: bytes(shown[c] for c in p) if all(c in shown for c in p) else p.encode() for p, i in vocab.items()}


@pytest.fixture(scope="module")
def brute():
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    a_bytes = token_bytes()

    def piece(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    def run(rows):
        found, counts = [], Counter()
        for d, t in rows:
            ids_a = a.encode(" " + t, add_special_tokens=False).ids if t else []
            ids_b = b.encode(t) if t else []
            want = (" " + (t or "")).encode()
            if not t or b"".join(a_bytes[i] for i in ids_a) != want or b"".join(map(piece, ids_b)) != want:
                found.append((d, 0, 0, [], ""))
                continue
            groups, i, j, at_a, at_b, ga, gb = [], 0, 0, 0, 0, [], []
            while i < len(ids_a) or j < len(ids_b):
                if at_a <= at_b and i < len(ids_a):
                    ga.append(ids_a[i])
                    at_a += len(a_bytes[ids_a[i]])
                    i += 1
                else:
                    gb.append(ids_b[j])
                    at_b += len(piece(ids_b[j]))
                    j += 1
                if at_a == at_b:
                    groups.append((ga, gb))
                    ga, gb = [], []
            links = [(x[-1], y[-1]) for x, y in groups]
            counts.update(links)
            text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
            found.append((d, len(ids_a), len(ids_b), links, hashlib.sha256(text.encode()).hexdigest()))
        most = Counter()
        for (_, y), n in counts.items():
            most[y] = max(most[y], n)
        return [(d, na, nb, len(links), len(links), sum(counts[p] == most[p[1]] for p in links), sum(counts[p] for p in links), h)
                for d, na, nb, links, h in found]
    return run


def got(df, **kw):
    return sorted((tuple(r) for r in al.aligned(df, **kw).select("doc_id", *COLUMNS).collect()), key=repr)


ROWS = [(1, "The quick brown fox, naïve café \U0001f600 日本語 text"), (2, None), (3, ""), (4, " "), (5, "two  spaces   and\ttabs\n\nlines"),
        (6, "ﬁne print ½ ＡＢＣ"), (7, "<|endoftext|> and </s><s> <unk> <0x41>"), (7, "<|endoftext|> and </s><s> <unk> <0x41>"),
        (8, "antidisestablishmentarianism " * 400), (9, "x" * 5000 + " 12345678901234567890    \r\n"), (None, "null id"),
        (10, "\x00 zero \x07 bell ﻿"), (11, "é combining"), (12, "ends with space "),
        (13, "a piece's mark ▁ in the text")]


@pytest.mark.parametrize("top,held", [(al.TOP, al.HELD), (3, 10), (1, 1)])
def test_equals_brute_force(spark, brute, monkeypatch, top, held):
    """Also with nearly all pairs outside the list of the most frequent and pair counts returned early."""
    monkeypatch.setattr(al, "TOP", top)
    monkeypatch.setattr(al, "HELD", held)
    df = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)
    df = df.withColumns({c: F.lit("x") for c in ("uid", "doc", "a", "b", "n", "sha", "kind", "n_a", "n_best", "more_sum")})
    want = sorted(brute(ROWS), key=repr)
    assert sum(r[1] > 0 for r in want) >= 8 and any(r[1] == 0 and r[0] == 13 for r in want)
    assert got(df) == want


def test_empty_table(spark):
    assert got(spark.createDataFrame([], "doc_id long, text string")) == []


def test_query_equals_brute_force(spark, brute):
    path = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()]
    mine = sorted((tuple(r) for r in al.op11_cross_tokenizer_alignment(spark, path).collect()), key=repr)
    assert mine == sorted(brute(rows), key=repr)


def test_segments_read_together_have_their_own_ids():
    pair = al.Pair(*(al.vocabulary(f) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model")))
    texts = [r or "" for r in pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["text"])["text"].to_pylist()]
    texts += ["a\n b  c \t d\n", "<|endoftext|> x", "é ñ 😀 \u2581 y", "don't  'll !! ## $5 ", " ", "\x00 \x85 z\xa0 q"]
    parts = list(dict.fromkeys(p for t in texts for p in al.SEGMENT.split(" " + t)))
    assert pair.encode_a(parts) == pair.ids_a(parts) and len(parts) > 3 * al.JOINED
    assert pair.encode_a([]) == []
