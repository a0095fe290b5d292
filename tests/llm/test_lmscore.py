import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterloom.llm import lmscore
from tests.llm.cases import awkward, documents, prose


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1


def uses(docs, held_out, aside=20):
    """How each (id, text) is used: 0 held out, 1 in the filter, 2 set aside."""
    rows = docs.select("doc_id", "text", (F.pmod(F.xxhash64("doc_id", "text", F.lit(5)), F.lit(aside)) == 0).alias("apart")).collect()
    return {(r.doc_id, r.text): 0 if held_out(r.doc_id) else 2 if r.apart else 1 for r in rows}


def quantised(n, base=2.0):
    """Least and largest count of the level of n."""
    if not n:
        return 0, 0
    level = 1 + math.floor(math.log(n, base) + 1e-9)
    return math.ceil(base ** (level - 1) - 1e-9), math.ceil(base**level - 1e-9) - 1


def true_scores(texts, use):
    """Scores by true counts, quantised as the filter does, with the best weights of the grid for what is set aside."""
    one, two, three = Counter(), Counter(), Counter()
    for i, x in texts:
        t = tokens(x)
        if use[i, x]:
            one.update(t)
        if use[i, x] == 1:
            two.update(zip([None, *t[:-1]], t, strict=True))
            three.update(zip([None, None, *t[:-2]] if len(t) > 1 else [None], [None, *t[:-1]], t, strict=True))
    n, v = sum(one.values()), len(one)

    def terms(x):
        t = tokens(x)
        for k, w in enumerate(t):
            b, u = t[k - 1] if k else None, t[k - 2] if k > 1 else None
            p1 = (one[w] + 0.5) / (n + 0.5 * (v + 1))
            r2 = min(quantised(two[b, w])[0], one[w], one[b]) / one[b] if one[b] else None
            high = quantised(two[u, b])[1] if k else 0
            r3 = min(quantised(three[u, b, w])[0], high) / high if high else None
            yield p1, r2, r3

    def score(ts, a, b):
        total = 0.0
        for p1, r2, r3 in ts:
            p = p1 if r2 is None else b * r2 + (1 - b) * p1
            total += math.log10(p if r3 is None else a * r3 + (1 - a) * p)
        return total

    apart = [list(terms(x)) for i, x in texts if use[i, x] == 2]
    a, b = max(lmscore.GRID, key=lambda g: sum(score(t, *g) for t in apart)) if apart else (0.1, 0.2)
    return {(i, x): score(list(terms(x)), a, b) for i, x in texts}, (a, b)


@pytest.fixture(scope="module")
def case(spark):
    shared = prose(77, 40)
    texts = awkward() + [(100 + i, prose(i, 30 + i % 50) + " " + (shared if i % 3 == 0 else "")) for i in range(200)]
    return texts, lmscore.op9(documents(spark, texts)).collect()


def test_base_equals_brute_force(case):
    texts, rows = case
    counts = Counter(t for i, x in texts if not held(i) for t in tokens(x))
    n, v = sum(counts.values()), len(counts)
    want = sorted(
        (-1 if i is None else i, held(i), len(tokens(x)), sum(counts[t] > 0 for t in tokens(x)), n,
         round(sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens(x)), 4))
        for i, x in texts
    )
    got = sorted(
        (-1 if r.doc_id is None else r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in rows
    )
    assert got == want


def test_ngrams_help_on_held_out_texts(case):
    _, rows = case
    some = [r for r in rows if r.held_out and r.doc_id and r.doc_id >= 100]
    assert sum(r.score for r in some) > sum(r.base_score for r in some)
    assert all(r.score <= 0 for r in rows)


def test_score_equals_exact_counts(spark, case):
    """True counts, rounded down to the least of their level, give the scores of all texts but for false hits."""
    texts, rows = case
    want, _ = true_scores(texts, uses(documents(spark, texts), held))
    exact = {}
    for (i, _), s in want.items():
        exact.setdefault(i, []).append(s)
    near = [min(abs(r.score - e) for e in exact[r.doc_id]) < 0.02 * abs(r.score) + 1e-6 for r in rows]
    assert sum(near) / len(near) > 0.97


def test_ngrams_that_occur_once_count(spark):
    """In training texts every n-gram occurs, most of them once, some of words that occur once."""
    texts = [(i, " ".join(f"w{(i * 37 + k * k) % 150}" if k % 7 else f"only{i}x{k}" for k in range(60))) for i in range(60)]
    texts += [(600 + i, texts[i][1]) for i in range(60) if i % 6 == 1]
    texts = [(i, f"{x} only{i + 1}x7 w{((i + 1) * 37 + 64) % 150}" if i % 6 == 0 else x) for i, x in texts]
    docs = documents(spark, texts)
    rows = lmscore.score_texts(docs, F.col("doc_id") % 6 != 0, bits_per_key=24).collect()
    want, _ = true_scores(texts, uses(docs, lambda i: i % 6 == 0))
    by_id = {i: s for (i, _), s in want.items()}
    assert all(r.score == pytest.approx(by_id[r.doc_id], rel=1e-3) for r in rows)


def test_both_ways_of_probing_read_the_same(spark):
    texts = [(i, prose(i % 90, 60)) for i in range(200)]
    docs = documents(spark, texts)
    key = lambda r: r.doc_id
    some = {"block_bytes": 4_000, "segment_bytes": 300, "bits_per_key": 24}
    whole = sorted(lmscore.score_texts(docs, F.lit(True), **some).collect(), key=key)
    passes = sorted(lmscore.score_texts(docs, F.lit(True), group_bytes=4_000, most_groups=10**6, **some).collect(), key=key)
    ranges = sorted(lmscore.score_texts(docs, F.lit(True), most_groups=0, **some).collect(), key=key)
    assert whole == passes == ranges and len(whole) == 200
    want, _ = true_scores(texts, uses(docs, lambda i: False))
    # Equal but for false hits, which a filter of 24 bits a key has once in some thousand probes.
    off = [abs(r.score / want[r.doc_id, texts[r.doc_id][1]] - 1) for r in whole]
    assert max(off) < 0.02 and sum(x < 1e-9 for x in off) > 0.9 * len(off)


def test_probing_needs_segments_and_keys_only(spark):
    """Segments of one corpus read the n-grams of another, and held-out rows leave no trace in them."""
    train = documents(spark, [(i, prose(i, 50)) for i in range(40)]).select("doc_id", F.lit(1).alias("training"), "text")
    other = documents(spark, [(900 + i, prose(900 + i, 50, "zi qo wu pel")) for i in range(10)])
    hidden = other.select("doc_id", F.lit(0).alias("training"), "text")
    make = lambda rows: lmscore.build_segments(
        lmscore.key_parts(lmscore.token_blocks(rows, 1 << 20), 6, training=True), 2.0, bits_per_key=12, probes=5
    )
    segments = make(train)
    bits = lambda s: {r.range: (r.size, bytes(r.bits)) for r in s.collect()}
    assert bits(segments) == bits(make(train.union(hidden)))
    read = lmscore.probe_by_range(lmscore.token_blocks(hidden, 1 << 20), segments, 6)
    levels = np.concatenate([np.frombuffer(bytes(r.levels), np.uint8) for r in read.collect()])
    assert (levels == 0).mean() > 0.97
    read = lmscore.probe_by_range(lmscore.token_blocks(train, 1 << 20), segments, 6)
    assert all((np.frombuffer(bytes(r.levels), np.uint8) > 0).all() for r in read.collect())


def test_segment_reads_levels_back():
    draw = np.random.default_rng(3)
    hashes, levels = np.unique(draw.integers(0, 2**40, 4000, dtype=np.uint64)), None
    levels = draw.integers(1, 6, len(hashes))
    segment = lmscore.Segment.build(hashes, levels, bits_per_key=12, probes=5)
    read = lmscore.Segment(segment.size, 5, segment.data.tobytes()).level(hashes)
    assert (read >= levels).all() and (read == levels).mean() > 0.97
    assert (segment.level(draw.integers(0, 2**40, 4000, dtype=np.uint64)) == 0).mean() > 0.97


def test_weights_are_those_of_the_grid(spark):
    """Texts that repeat whole phrases call for trigrams; texts of words drawn alone don't."""
    draw = np.random.default_rng(1)
    phrases = [" ".join(f"p{k}w{j}" for j in draw.permutation(6)) for k in range(30)]
    fixed = [(i, " ".join(draw.choice(phrases, 12))) for i in range(200)]
    loose = [(i, " ".join(f"w{k}" for k in draw.integers(0, 400, 60))) for i in range(200)]
    want = []
    for texts in (fixed, loose):
        docs = documents(spark, texts)
        want.append(true_scores(texts, uses(docs, lambda i: False))[1])
        rows = lmscore.score_texts(docs, F.lit(True)).collect()
        assert len(rows) == 200
    assert want[0][0] + want[0][1] > want[1][0] + want[1][1]


def test_packing_round_trips():
    x = np.array([0, 1, 2**40 - 1, 2**63 + 5], np.uint64)
    assert (lmscore._unpack40(lmscore._pack40(x)) == (x & lmscore._LOW)).all()
    n = np.array([0, 1, 255, 256, 2**31 - 1])
    assert (lmscore._unpack32(lmscore._pack32(n)) == n).all()


def test_nothing_to_learn_from(spark):
    rows = lmscore.score_texts(documents(spark, [(1, "a b"), (2, None)]), F.lit(False)).collect()
    assert {(r.doc_id, r.n_tokens, r.n_known, r.train_tokens) for r in rows} == {(1, 3, 0, 0), (2, 1, 0, 0)}
    assert lmscore.op9(documents(spark, awkward()).limit(0)).count() == 0


def test_ranges_probe_what_they_build_and_rows_set_aside_have_their_own_blocks(spark):
    texts = [(i, prose(i % 90, 60)) for i in range(200)]
    docs = documents(spark, texts)
    some = {"block_bytes": 4_000, "segment_bytes": 300, "bits_per_key": 24}
    key = lambda r: r.doc_id
    once = sorted(lmscore.score_texts(docs, F.col("doc_id") % 6 != 0, **some).collect(), key=key)
    met = lmscore.score_texts(docs, F.col("doc_id") % 6 != 0, most_groups=1, group_bytes=1, **some)
    assert once == sorted(met.collect(), key=key) and len(once) == 200

    use = uses(docs, lambda i: i % 6 == 0)
    rows = spark.createDataFrame([(i, use[i, x], x) for i, x in texts], "doc_id long, training int, text string")
    blocks = lmscore.token_blocks(rows, 4_000).collect()
    assert all((r.block % 2 == 1) == (u == 2) for r in blocks for u in bytes(r.training))
    assert len({r.block for r in blocks}) == len(blocks) and sum(len(r.ids) for r in blocks) == 200
    # All keys go once, with the counts of the training rows among them.
    blocks = lmscore.token_blocks(rows, 4_000)
    every, trained = lmscore.key_parts(blocks, 6, training=None), lmscore.key_parts(blocks, 6, training=True)
    total = lambda parts: sum(int(lmscore._unpack32(bytes(r.counts)).sum()) for r in parts.collect())
    assert total(every) == total(trained) == 2 * sum(len(tokens(x)) for i, x in texts if use[i, x] == 1)
