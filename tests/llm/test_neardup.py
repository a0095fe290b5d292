import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterloom.llm import neardup
from meterloom.llm.graph import components
from meterloom.llm.shingles import BUFFER, shingle_sets, word_hashes
from tests.llm.cases import awkward, documents, prose


def words(text):
    return (text or "").encode().lower().split()


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(texts, percent):
    """Components over all pairs; rows of one id are one node."""
    sets, parent = defaultdict(list), {}
    for i, t in texts:
        if i is not None:
            sets[i].append(shingles(t))
            parent[i] = i

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            for x in sets[a]:
                for y in sets[b]:
                    if x and y and 100 * len(x & y) >= percent * len(x | y):
                        lo, hi = sorted((find(a), find(b)))
                        parent[hi] = lo
    return {i: find(i) for i in ids}


def edited(text, share, seed):
    draw = random.Random(seed)
    return " ".join(f"z{draw.random()}" if draw.random() < share else w for w in text.split())


def family():
    """A base with copies at every distance, chains, a passage in many texts and unrelated texts."""
    base, passage = prose(1, 200), prose(2, 120)
    texts = [(100, base), (101, base + "  "), (102, base.upper())]
    texts += [(200 + i, edited(base, 0.002 * (i % 25), i)) for i in range(60)]
    chain = base
    for i in range(8):
        chain = edited(chain, 0.012, 900 + i)
        texts.append((300 + i, chain))
    texts += [(400 + i, passage + " " + prose(50 + i, 10 + 3 * i)) for i in range(40)]
    texts += [(500 + i, prose(500 + i, 30)) for i in range(30)]
    # Two links between texts that share the passage with everybody.
    texts += [(600, passage + " " + prose(71, 60)), (601, passage + " " + prose(71, 60) + " end")]
    return texts


@pytest.mark.parametrize("percent", [85, 80])
def test_components_equal_brute_force(spark, percent):
    texts = family()
    rows = neardup.op6(documents(spark, texts), percent).collect()
    want = brute(texts, percent)
    assert {r.doc_id: r.component_id for r in rows} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    assert {r.doc_id: r.n_shingles for r in rows} == {i: len(shingles(t)) for i, t in texts}


def test_awkward_rows(spark):
    texts = awkward()
    rows = neardup.op6(documents(spark, texts)).collect()
    want = brute([(i, t) for i, t in texts if i != 4 or "other" not in t], 85)
    assert len(rows) == len(texts)
    for r in rows:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert r.component_id == want[r.doc_id]
    assert neardup.op6(documents(spark, texts).limit(0)).count() == 0


def test_one_of_each_keeps_columns_and_one_row(spark):
    """One row of each (id, set); ids repeat only where their texts have different sets."""
    texts = awkward() + family()
    docs = documents(spark, texts)
    kept = neardup.one_of_each(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert [r.doc_id for r in rows].count(None) == 2
    got = [(r.doc_id, frozenset(shingles(r.text))) for r in rows if r.doc_id is not None]
    assert len(got) == len(set(got))
    assert {i for i, _ in got} == {i for i, c in brute(texts, 80).items() if i == c}
    assert sorted(i for i, _ in got if [j for j, _ in got].count(i) > 1) == [4, 4]


def revisions(n, words=300, changed=9, seed=5):
    """Two revisions of a page, n copies of each with one word of their own."""
    draw = random.Random(seed)
    first = [f"w{draw.random():.9f}" for _ in range(words)]
    second = list(first)
    for i in range(changed):
        second[10 + i * (words // changed)] = f"v{i}x"
    texts = []
    for i in range(n):
        for k, page in enumerate((first, second)):
            own = list(page)
            own[draw.randrange(words)] = f"p{i}x{k}"
            texts.append((2 * i + k, " ".join(own)))
    return texts


def test_revisions_cost_no_square(spark, monkeypatch):
    """Rows of every step, and the pairs that the label join compares, grow with n and not with n * n."""

    def work(n):
        seen = Counter()
        real = neardup.stored

        def counted(df, name, **options):
            out = real(df, name, **options)
            seen[name] += out.count()
            if name == "star-places":  # an upper bound of what the label join compares
                keys = out.groupBy("key").agg(F.count_distinct("label").alias("n"))
                seen["compared"] += keys.agg(F.sum(F.col("n") * F.col("n"))).first()[0] or 0
            return out

        monkeypatch.setattr(neardup, "stored", counted)
        rows = neardup.op6(documents(spark, revisions(n))).collect()
        monkeypatch.setattr(neardup, "stored", real)
        assert {r.component_id for r in rows} == {0, 1} and all(r.component_id == r.doc_id % 2 for r in rows)
        return seen

    small, large = work(250), work(1000)
    for name, n in large.items():
        assert n <= 2.2**2 * max(small[name], 250), (name, small[name], n)


@pytest.mark.parametrize("seed", range(3))
def test_near_crowds_equal_brute_force(spark, seed):
    """Crowds at every distance around the threshold, whose outer members may or may not reach across."""
    draw = random.Random(seed)
    texts, base = [], [f"w{draw.random():.9f}" for _ in range(120)]
    for crowd in range(7):
        centre = list(base)
        for at in draw.sample(range(120), draw.choice([1, 2, 2, 3, 3, 4])):
            centre[at] = f"c{crowd}x{at}"
        for _ in range(draw.choice([1, 3, 12, 25])):
            own = list(centre)
            for at in draw.sample(range(120), draw.choice([0, 0, 1, 1, 2])):
                own[at] = draw.choice([base[at], f"o{draw.randrange(40)}", f"o{draw.random()}"])
            texts.append((len(texts), " ".join(own)))
    rows = neardup.op6(documents(spark, texts)).collect()
    assert {r.doc_id: r.component_id for r in rows} == brute(texts, 85)


def test_a_hub_with_more_members_than_a_group(spark, monkeypatch):
    monkeypatch.setattr(neardup, "_GROUP", 3)
    texts = family()
    rows = neardup.op6(documents(spark, texts), 80).collect()
    assert {r.doc_id: r.component_id for r in rows} == brute(texts, 80)


def test_word_hashes_do_not_depend_on_buffers():
    long = b"x" * (2 * BUFFER + 17)
    text = long + b" y " + b"z " * (BUFFER // 2 + 100)
    hashes = word_hashes(text)
    assert hashes[0] == word_hashes(long)[0] and hashes[1] == word_hashes(b"y")[0] and hashes[-1] == word_hashes(b"z")[0]
    assert len(hashes) == 2 + BUFFER // 2 + 100
    mixed = ["a b c d e f", None, "", "A B C d e F", "x" * (BUFFER + 5), "a b"]
    with np.errstate(over="ignore"):
        sets = shingle_sets(mixed)
    assert [len(s) for s in sets] == [2, 0, 0, 2, 1, 1] and (sets[0] == sets[3]).all()


def test_sketches_merge_and_estimate():
    draw = np.random.default_rng(2)
    with np.errstate(over="ignore"):
        for share in (0.95, 0.8, 0.5):
            errors = []
            for _ in range(30):
                x = draw.integers(0, 2**63, 1200, dtype=np.uint64)
                both = int(1200 * share / (2 - share) * (2 - share) / 1)
                both = int(2 * share * 600 / (1 + share) * 2)
                a, b = x[: 600 + both // 2], x[600 - both // 2 :]
                true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
                sa, sb = neardup.sketch(a), neardup.sketch(b)
                assert (np.maximum(sa, sb) == neardup.sketch(np.union1d(a, b))).all()
                guess = neardup.estimate(sa[None], sb[None], np.array([len(a)]), np.array([len(b)]))[0]
                errors.append(guess - true)
            assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.08


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(1001, 1050)] + [(1020, 900), (5, 5)]
    found = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(found[i] == 0 for i in range(61))
    assert all(found[i] == 900 for i in range(1000, 1050))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_different_texts_of_one_id_stay(spark):
    a, b, c = (prose(7000 + i, 60) for i in range(3))
    # 9 is a copy of 3 in one row and clean in another; 3 and 4 hold the smallest ids of several groups.
    texts = [(3, a), (9, a), (9, b), (3, c), (4, c), (4, c + " end"), (4, ""), (4, ""), (3, a), (3, a.upper())]
    kept = neardup.one_of_each(documents(spark, texts)).collect()
    got = sorted((r.doc_id, r.text.lower()) for r in kept)
    assert got == sorted([(3, a.lower()), (9, b.lower()), (3, c.lower()), (4, "")])
