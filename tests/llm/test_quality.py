import re
from collections import Counter

import pytest

from meterloom.llm import quality
from tests.llm.cases import awkward, documents, prose


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(5)}
    lines, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in lines
            lines.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
REPEATS = [
    "a b c d e a b c d e", "a a a a a", "a a a a a a", "a b c d e f a b c d e x f a b c d e", "w " * 3000,
    "one two\none two\n \n \none two ", "<a> & #b *c $d %e |f", "a b c d e\x85a b c d e",
]


def test_base_statistics(spark):
    texts = awkward() + [(100 + i, t) for i, t in enumerate(REPEATS)]
    rows = quality.op3(documents(spark, texts)).collect()
    want = Counter((i, *brute(t)) for i, t in texts)
    assert Counter((r.doc_id, *[r[c] for c in BASE]) for r in rows) == want
    for r in rows:
        failed = r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words
        assert r.base_failed == failed and not (failed and r.kept)


@pytest.fixture(scope="module")
def judged(spark):
    texts = [(i, prose(i, 60 + i % 200)) for i in range(400)]
    junk = {
        1000: prose(7, 90).upper().replace(" ", "!! "),
        1001: prose(8, 90).replace(" ", "%%% "),
        1002: " | ".join(prose(9, 80).split()),
        1003: "\n".join(f"{x} {i // 2}" for i, x in enumerate(["same line of words here"] * 30)),
    }
    docs = documents(spark, texts + list(junk.items())).union(documents(spark, [(2000, prose(3, 100)), (2001, None)], lang=None))
    return docs, {r.doc_id: r for r in quality.op3(docs).collect()}


def test_outliers_go_and_clean_texts_stay(judged):
    _, rows = judged
    assert all(rows[i].kept for i in range(400))
    assert not any(rows[i].kept for i in (1000, 1001, 1002, 1003, 2001))
    assert rows[2000].kept


def test_passed_keeps_columns(judged):
    docs, rows = judged
    kept = quality.passed(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, r in rows.items() if r.kept)
    assert quality.passed(docs.limit(0)).count() == 0


def test_estimate_resists_outliers(spark):
    import numpy as np

    draw = np.random.default_rng(1)
    x = draw.normal(size=(2000, 6)) * [1, 2, 1, 0.5, 1, 1] + [0, 3, 0, 1, 0, 0]
    x[:, 1] += 0.8 * x[:, 0]
    x[:500] += 50
    rows = spark.createDataFrame([("g", "l", *map(float, r)) for r in x], ["group", "lang_key", *[f"x_{i}" for i in range(6)]])
    found = quality.estimate(rows).first()
    assert abs(found.m_0) < 0.25 and abs(found.m_1 - 3) < 0.4
    assert 0.2 < found.l_1_0 < 1.5


def table_of(spark, x, group="g"):
    return spark.createDataFrame([(group, "l", *map(float, r)) for r in x], ["group", "lang_key", *[f"x_{i}" for i in range(6)]])


def test_core_quantile_is_the_chi_square_one(spark):
    """On normal data of any shape, so that one cut means the same in every group."""
    import numpy as np

    draw = np.random.default_rng(2)
    frames = []
    for k, scale in enumerate([1.0, 30.0]):
        x = draw.normal(size=(4000, 6)) * scale
        x[:, 2] += 0.9 * x[:, 3]
        frames.append(table_of(spark, x, f"g{k}"))
    rows = frames[0].union(frames[1])
    found = quality.estimate(rows, prior=0.0)
    d2 = quality._distance(rows.join(found, "group"))
    for r in d2.groupBy("group").agg({"d2": "count"}).collect():
        own = np.array([x.d2 for x in d2.where(d2.group == r.group).select("d2").collect()])
        assert np.quantile(own, 0.75) == pytest.approx(quality.CHI_SQUARE, rel=0.03)


def test_the_start_with_the_smallest_determinant_stays(spark, monkeypatch):
    """Not quite a quarter of far rows, close together, drags the mean of all rows along; steps from there end in a worse subset."""
    import numpy as np
    from pyspark.sql import functions as F

    draw = np.random.default_rng(3)
    x = draw.normal(size=(1200, 6))
    x[:288] = draw.normal(size=(288, 6)) * 0.3 + [12, -12, 12, -12, 12, 12]
    rows = table_of(spark, x)
    real = quality.starts
    alone = []
    for k in range(3):
        monkeypatch.setattr(quality, "starts", lambda v, a, k=k: real(v, a).where(F.col("start") == k))
        alone.append(quality.estimate(rows).first().log_det)
    monkeypatch.setattr(quality, "starts", real)
    best = quality.estimate(rows).first()
    assert best.log_det == pytest.approx(min(alone), abs=0.01)
    assert max(alone) > min(alone) + 0.5, alone
    assert abs(best.m_0) < 0.5


def test_a_group_without_spread_and_a_group_of_one(spark):
    rows = table_of(spark, [[1, 2, 3, 4, 5, 6]] * 30).union(table_of(spark, [[0, 0, 0, 0, 0, 0]], "h"))
    found = {r.group: r for r in quality.estimate(rows, prior=0.0).collect()}
    assert set(found) == {"g", "h"} and all(r[f"l_{i}_{i}"] > 0 for r in found.values() for i in range(6))


def test_passing_stores_measures_and_not_the_documents_again(spark, monkeypatch):
    from pyspark.sql import functions as F

    texts = [(i, prose(i, 30)) for i in range(60)] + [(60, "too short"), (61, None), (7, prose(7, 30))]
    docs = documents(spark, texts)
    kinds, real = [], quality.stored
    monkeypatch.setattr(quality, "stored", lambda df, name, **o: (kinds.append(df.schema.simpleString()), real(df, name, **o))[1])
    kept = quality.passed(docs).collect()
    assert kinds and not any("text" in kind for kind in kinds)
    monkeypatch.undo()
    want = quality.judged(docs, keep=docs.columns).where(~F.col("rejected")).select("doc.*").collect()
    assert sorted(kept, key=str) == sorted(want, key=str) and 50 < len(kept) < 62
