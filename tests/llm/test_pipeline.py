"""The pipeline on the smallest tables: each stage against brute force on its own input."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from meterloom.llm import neardup, pii, quality
from meterloom.llm.common import stored
from meterloom.llm.queries import ORACLES, QUERIES, word_tokenizer
from tests.llm.cases import awkward, documents
from tests.llm.test_decontam import brute as leaks
from tests.llm.test_neardup import brute as groups
from tests.llm.test_quality import brute as statistics

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").unionByName(
        documents(spark, [(i and i + 10**6, t) for i, t in awkward()]).select("doc_id", "text", "lang", "source", "n_chars")
    )
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(stored(stage(spark, kept[-1], SF_DIR), name))
    return kept


def texts(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_names_and_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "personal_data", "packing"]
    assert all(df.columns == stages[0].columns for df in stages[:-1])


def test_quality_stage(stages):
    before, after = texts(stages[0]), texts(stages[1])
    assert set(after) <= set(before) and len(after) > 0.5 * len(before)
    for _, text in after:
        n, _, _, _, repeated = statistics(text)
        assert n >= 10 and 100 * repeated <= 20 * n


def test_near_duplicate_stage(stages):
    before, after = texts(stages[1]), texts(stages[2])
    want = groups(before, 80)
    assert sorted(i for i, _ in after if i is not None) == sorted(i for i, c in want.items() if i == c)


def test_decontamination_stage(spark, stages):
    before, after = texts(stages[2]), texts(stages[3])
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    short = [(i, t) for i, t in before if len(t) < 20_000]
    gone = {d for d, _ in leaks(short, items)}
    assert {i for i, _ in before} - {i for i, _ in after} >= gone
    assert len(before) - len(after) <= len(gone) + len(before) - len(short)


def test_personal_data_stage(stages):
    after = dict(texts(stages[4]))
    for doc_id, text in texts(stages[3]):
        assert after[doc_id] == pii.mask(text, pii.find_spans(text))
    assert all(r.n_chars == len(r.text) for r in stages[4].collect())


def test_packing_stage(stages):
    tokenizer = Tokenizer.from_file(word_tokenizer())
    want = {i: tokenizer.encode(t, add_special_tokens=False).ids + [1] for i, t in texts(stages[4])}
    got = {}
    for r in sorted(stages[5].collect(), key=lambda r: r.start):
        got.setdefault(r.doc_id, []).extend(np.frombuffer(r.tokens, "<u4").tolist())
    assert got == want


def test_registration():
    assert set(QUERIES) | {"pipeline"} <= set(queries())
    assert set(ORACLES) <= set(oracle_sql()) and "pipeline" not in oracle_sql()
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 11))


def test_odd_column_names_pass_through(spark):
    docs = documents(spark, [(i, t) for i, t in awkward() if i is not None and i > 9]).withColumn("a.b `c`", F.lit(1))
    for stage in (quality.passed, neardup.one_of_each, pii.masked_texts):
        kept = stage(docs)
        assert kept.columns == docs.columns and kept.where("`a.b ``c``` <> 1").count() == 0
