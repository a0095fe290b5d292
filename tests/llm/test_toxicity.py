import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterloom.llm import toxicity
from tests.llm.cases import awkward, documents, prose

INSULTS = ["zork", "blargh", "fnord"]


def corpus(n=900, seed=2):
    draw = random.Random(seed)
    texts, labels = [], []
    for i in range(n):
        words = prose(seed * 10_000 + i, draw.randint(20, 150)).split()
        toxic = i % 7 == 0
        for _ in range(draw.randint(2, 4) if toxic else draw.random() < 0.05):
            words.insert(draw.randrange(len(words)), draw.choice(INSULTS))
        texts.append((i, " ".join(words)))
        if i % 5:
            labels.append((i, 1, int(toxic)))
    return texts, labels


def label_frame(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def case(spark):
    texts, labels = corpus()
    texts = texts + [(i + 5000 if i is not None else None, x) for i, x in awkward()]
    return texts, labels, toxicity.op11(documents(spark, texts), label_frame(spark, labels)).collect()


def test_held_out_texts_are_told_apart(case):
    texts, _, rows = case
    assert len(rows) == len(texts)
    for r in rows:
        assert r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [r for r in rows if r.held_out and r.doc_id is not None and r.doc_id < 900]
    assert np.mean([r.predicted == (r.doc_id % 7 == 0) for r in held]) > 0.95
    # Texts without a label are scored like the others.
    assert np.mean([r.predicted == (r.doc_id % 7 == 0) for r in rows if r.doc_id is not None and r.doc_id < 900 and r.doc_id % 5 == 0]) > 0.95


def test_labels_of_held_out_rows_teach_nothing(spark, case):
    texts, labels, rows = case
    held = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    turned = [(i, q, 1 - t if held(i) else t) for i, q, t in labels]
    again = toxicity.op11(documents(spark, texts), label_frame(spark, turned)).collect()
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.score)
    assert [r.score for r in sorted(again, key=key)] == pytest.approx([r.score for r in sorted(rows, key=key)], abs=1e-9)


def test_models_equal_brute_force(spark):
    texts, labels = corpus(300)
    docs = documents(spark, texts)
    model = toxicity.fit(docs, label_frame(spark, labels), F.lit(True))
    sample, _ = toxicity.training_sample(
        docs, label_frame(spark, labels), F.lit(True), "toxic", rows=8000, text=50_000, chars=24_000_000
    )
    one, two, before = [{}, {}], [{}, {}], {}
    for r in sample.where("fold > 0").collect():
        words = toxicity.words_of(r.text)
        for v, w in zip(["", *words[:-1]], words, strict=True):
            one[r.toxic][w] = one[r.toxic].get(w, 0) + 1
            two[r.toxic].setdefault(v, {})[w] = two[r.toxic].setdefault(v, {}).get(w, 0) + 1
            before.setdefault(w, set()).add(v)
    kinds = sum(map(len, before.values()))
    shared = lambda w: (len(before.get(w, ())) + 0.5) / (kinds + 0.5 * (len(before) + 1))

    def p(q, v, w):
        uni = (max(one[q].get(w, 0) - 1, 0) + len(one[q]) * shared(w)) / sum(one[q].values())
        own = two[q].get(v)
        both = (max(own.get(w, 0) - 1, 0) + len(own) * uni) / sum(own.values()) if own else uni
        return uni, both

    for _, text in texts[:40] + [(0, "never seen zork zork words zork")]:
        words = toxicity.words_of(text)
        ratios = []
        for v, w in zip(["", *words[:-1]], words, strict=True):
            (u0, b0), (u1, b1) = p(0, v, w), p(1, v, w)
            ratios.append([np.log(0.99 + 0.01 * b1 / b0), np.log(0.99 + 0.01 * u1 / u0)])
        want = [*np.mean(ratios, axis=0), np.log1p(len(words))]
        assert model.features([text])[0] == pytest.approx(want, abs=1e-9)


def test_rare_expressions_tell_nothing(spark):
    """A word that one class has once is worth no more than an unseen one."""
    texts, labels = corpus(300)
    model = toxicity.fit(documents(spark, texts + [(1001, "oncetoxic " + texts[0][1])]), label_frame(spark, labels + [(1001, 1, 1)]), F.lit(True))
    assert model.features(["oncetoxic"])[0].tolist() == pytest.approx(model.features(["neverseen"])[0].tolist())
    assert model.features(["zork"])[0][1] > model.features(["neverseen"])[0][1]


def test_empty_and_missing(spark):
    texts, labels = corpus(60)
    docs, known = documents(spark, texts), label_frame(spark, labels)
    assert toxicity.op11(docs.limit(0), known).count() == 0
    without = toxicity.op11(docs, known.limit(0)).collect()
    assert len(without) == 60 and {r.score for r in without} == {0.5}
    ordinary = toxicity.op11(docs, known.where("toxic = 0")).collect()
    assert len({r.score for r in ordinary}) == 1 and ordinary[0].score < 0.01
    odd = spark.createDataFrame([(1, None), (None, 1), (2, 7), (999_999, 1)], "doc_id long, toxic int")
    assert {r.score for r in toxicity.op11(docs, odd.withColumn("text", F.lit("x"))).collect()} <= {0.5, 1 - 1e-6}


def test_sample_is_bounded(spark):
    texts, labels = corpus(600)
    sample, sizes = toxicity.training_sample(
        documents(spark, texts), label_frame(spark, labels), F.lit(True), "toxic", rows=40, text=10_000, chars=8_000
    )
    rows = sample.collect()
    for q in (0, 1):
        assert sum(len(r.text) for r in rows if r.toxic == q) <= 8_000
    assert sizes[0] + sizes[1] == len(labels) and 0 < len(rows) < 130
