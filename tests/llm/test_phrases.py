import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterloom.llm import phrases
from tests.llm.cases import awkward, documents, prose

COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def brute(texts, least=10, share=50, top=2000):
    """texts: (lang, text)."""
    grams, totals = {}, Counter()
    for lang, text in texts:
        lang = "und" if lang is None else lang
        own = grams.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\n-\r]", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")):
            words = re.findall(r"[^ \t]+", piece)
            totals[lang] += len(words)
            for k in (1, 2, 3):
                own.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in grams.items():
        kept = []
        candidates = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        longest = Counter()
        for g, a in candidates.items():
            if len(g) == 3:
                for part in {g[:2], g[1:]}:
                    longest[part] = max(longest[part], a)
        for g, a in candidates.items():
            if len(g) == 2 and 100 * longest[g] >= share * a and longest[g]:
                continue
            score, k = min((1000000 * a * a // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
            kept.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -s))
    return sorted(out)


def got(frame):
    assert frame.columns == list(COLUMNS)
    return sorted(tuple(r) for r in frame.collect())


def corpus():
    """Phrases inside phrases, a word that most n-grams start with, ties, pieces, languages and nulls."""
    draw = random.Random(3)
    words = [f"w{i}" for i in range(40)] + ["the"] * 60 + ["é", "日本", "a\x0bb", "\x85", "x-y"]
    texts = []
    for i in range(300):
        text = []
        for _ in range(draw.randint(0, 60)):
            text.append(draw.choice([*draw.choices(words, k=3), "new york city", "New York", "of the", "end. Of", "tab\tsep", "a,b;c"]))
        texts.append((draw.choice(["en", "de", None, "und"]), " ".join(text)))
    return texts + [("en", t) for _, t in awkward()] + [("de", prose(i % 9, 200)) for i in range(40)]


def frame(spark, texts):
    return documents(spark, [(i, t) for i, (_, t) in enumerate(texts)]).drop("lang").join(
        spark.createDataFrame([(i, lang) for i, (lang, _) in enumerate(texts)], "doc_id long, lang string"), "doc_id"
    )


def test_phrases_equal_brute_force(spark):
    texts = corpus()
    assert got(phrases.op12(frame(spark, texts))) == brute(texts)


def test_small_blocks_cut_pieces_and_add_up(spark):
    """Blocks of seven words: pieces are cut everywhere, shards are many, and nothing is lost or counted twice."""
    texts = corpus()[:120] + [("en", "new york city " * 200)]
    assert got(phrases.phrases(frame(spark, texts), block_tokens=7)) == brute(texts)


def test_top_and_ties(spark):
    texts = corpus()
    assert got(phrases.phrases(frame(spark, texts), top=7)) == brute(texts, top=7)
    assert got(phrases.phrases(frame(spark, texts), least=25, share=80)) == brute(texts, least=25, share=80)


def test_ranges_and_lookup_groups(spark, monkeypatch):
    """Many ranges, so that one word spans several, and lookups in groups of five."""
    texts = corpus()
    real = phrases.part_counts
    monkeypatch.setattr(phrases, "part_counts", lambda rows, t, s: real(rows, t, s, lookups=5))
    real_splitters = phrases.splitters_of
    monkeypatch.setattr(phrases, "splitters_of", lambda docs: real_splitters(docs, range_bytes=2_000, sample=40))
    assert got(phrases.op12(frame(spark, texts))) == brute(texts)


def test_counts_beyond_64_bits(spark):
    """a * a * 10^6 and l * r pass 64 bits."""
    rows = [("en", 1, 2, None, 9 * 10**12, None, 10**13, 10**14, None)]
    counted = spark.createDataFrame(rows, "lang string, w1 long, w2 long, w3 long, a long, l2 long, l1 long, r1 long, r2 long")
    scored = counted.select(F.expr(phrases.SCORE.format(l="l1", r="r1")).alias("s")).first().s
    assert scored == 1000000 * (9 * 10**12) ** 2 // (10**13 * 10**14)


def test_transducers_hold_what_they_are_given():
    draw = np.random.default_rng(4)
    table = np.unique(draw.integers(1, 2**63, 50, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
    grams = Counter()
    for _ in range(3000):
        g = draw.zipf(1.5, 3) % 50
        for k in (1, 2, 3):
            grams[tuple(g[:k].tolist())] += 1
    by = [sorted((g, n) for g, n in grams.items() if len(g) == k) for k in (1, 2, 3)]
    parts = [(*(np.array([g[i] for g, _ in rows]) for i in range(k + 1)), np.array([n for _, n in rows])) for k, rows in enumerate(by)]
    made = phrases.Transducer.unpack(phrases.Transducer.build(table, *parts).pack())
    h1, h2, h3, n = made.paths()
    place = {int(h): i for i, h in enumerate(table)}
    read = {tuple(place[int(x)] for x in row if x): int(c) for *row, c in zip(h1, h2, h3, n, strict=True)}
    assert read == dict(grams)
    # Equal states are one: fewer are stored than prefixes there are.
    assert len(made.third) < len(by[2]) and len(made.begin2) < len({g[:2] for g, _ in by[2]})
    asked = [(a, b) for a in range(50) for b in (None, *range(50))]
    found = made.compose(
        np.array([table[a] for a, _ in asked]), np.array([0 if b is None else table[b] for _, b in asked], np.uint64)
    )
    assert found.tolist() == [grams.get((a,) if b is None else (a, b), 0) for a, b in asked]
    whole = phrases._united([made, made, made], 4)
    *h, n = whole.paths()
    assert sorted(n.tolist()) == sorted(3 * c for c in grams.values() if 3 * c >= 4)


@pytest.mark.parametrize("texts", [[], [(None, None)], [("en", "a b"), ("de", "")]])
def test_nothing_to_find(spark, texts):
    rows = frame(spark, texts) if texts else frame(spark, [("en", "a")]).limit(0)
    assert got(phrases.op12(rows)) == []
