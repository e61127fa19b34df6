"""The corpus pipeline: five operators over ``documents``, each stage written and read again.

1 quality rules      rejected documents go; lines above a host's limits leave the texts kept
2 near duplicates    one document of each SimHash class stays
3 decontamination    documents that hold a benchmark item go
4 secret scan        secrets in the texts are replaced by a mark
5 packing            the texts become pieces in sequences of 1024 tokens

Defined results: a NULL or empty text fails the quality rules; of copies, and of rows repeated whole, one row
stays; NULL ids are ids like any other; an empty table gives no rows.  All columns of the documents pass through
the first four stages, whatever their names; ``n_chars`` follows a changed text where the table has that column.
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from stratus.llm import decontaminate, packing, quality_rules, secrets_scan, simhash  # noqa: E402
from stratus.llm.common import fresh, table  # noqa: E402
from stratus.sources.materialize import materialize  # noqa: E402


def _with_text(docs, rows, text):
    """``docs``' columns with a new text; n_chars follows where the text changed."""
    changed = ~F.col("text").eqNullSafe(text)
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(changed, F.length(text).cast("long")).otherwise(F.col("n_chars")))
    return rows.withColumn("text", text).select(*docs.columns)


def quality_stage(spark, docs, sf_dir):
    name = fresh(docs, "quality")
    rows = quality_rules.apply_rules(docs, name=name).where(F.col(name)["kept"])
    return _with_text(docs, rows, F.col(name)["clean_text"])


def near_duplicate_stage(spark, docs, sf_dir):
    return simhash.drop_near_duplicates(docs)


def decontamination_stage(spark, docs, sf_dir):
    name = fresh(docs, "leaks")
    rows = decontaminate.with_leaks(docs, table(spark, sf_dir, "benchmark"), name=name)
    return rows.where(F.size(name) == 0).select(*docs.columns)


def secrets_stage(spark, docs, sf_dir):
    name = fresh(docs, "found")
    rows = secrets_scan.redacted(docs.withColumn(name, F.col("text")), name)
    return _with_text(docs, rows, F.col(name))


def packing_stage(spark, docs, sf_dir):
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("secret_scans", secrets_stage),
    ("best_fit_packing", packing_stage),
]

#: Near-duplicate classes, decontamination and tokenisation have no SQL form; tests/llm/test_pipeline.py holds every
#: stage against plain Python on a small fixture.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
