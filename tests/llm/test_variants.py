import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from meterloom.llm import variants
from tests.llm.cases import awkward, documents, prose


def counts(texts):
    found = Counter()
    for i, x in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", x or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words):
    near = defaultdict(list)
    for a in words:
        for b in words:
            if one_edit(a, b):
                near[a].append(b)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 5 * n else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w] or "", root(w), n, len(near[w]), words.get(form[w]) or 0) for w, n in words.items())


def rows(frame):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in frame.collect())


def corpus():
    """Misspellings of every kind, chains of forms, words of equal counts, accents, long words."""
    draw = random.Random(8)
    stems = ["colour", "behaviour", "straße", "naïvement", "abcdef", "x" * 70, "élevage", "zzzzzz"]
    bag = []
    for stem in stems:
        bag += [stem] * 700
        for _ in range(12):
            at = draw.randrange(len(stem))
            bag += [draw.choice([stem[:at] + stem[at + 1 :], stem[:at] + "q" + stem[at:], stem[:at] + "k" + stem[at + 1 :]])] * draw.choice([5, 7, 20, 130])
    bag += ["mmmmmm"] * 10 + ["mmmmmn"] * 50 + ["mmmmnn"] * 250 + ["mmmnnn"] * 1250
    draw.shuffle(bag)
    return [(i, " ".join(bag[i * 50 : i * 50 + 50])) for i in range(-(-len(bag) // 50))]


def test_forms_equal_brute_force(spark):
    texts = corpus() + awkward() + [(9000 + i, prose(i % 20, 80)) for i in range(60)]
    assert rows(variants.op13(documents(spark, texts))) == brute(counts(texts))


@pytest.mark.parametrize("tile", [2, 7])
def test_tiles_lose_and_repeat_no_pair(spark, tile):
    words = counts(corpus() + [(9000 + i, prose(i % 20, 80)) for i in range(60)])
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    pairs = [tuple(sorted((r.x, r.y))) for r in variants.near_pairs(frame, tile).collect()]
    ordered = sorted(words)
    assert sorted(pairs) == [(a, b) for i, a in enumerate(ordered) for b in ordered[i + 1 :] if one_edit(a, b)]


def test_slices_of_a_unit(monkeypatch, spark):
    monkeypatch.setattr(variants, "_CELLS", 20)
    words = ["abcdef", "abcdeg", "bcdef", "abcde", "xbcdef", "abcxef"]
    found = {tuple(sorted((x, y))) for k in (True, False) for x, y, _, _ in variants._near(words, [1] * 6, [True] * 6, (6, k, 0, 0, 0))}
    want = {(a, b) for a in words for b in words if a < b and max(len(a), len(b)) == 6 and one_edit(a, b)}
    assert found == want


def test_counts_are_flushed_and_added(monkeypatch, spark):
    monkeypatch.setattr(variants, "_HELD", 3)
    texts = corpus()[:20]
    got = {r.word: r.n for r in variants.word_counts(documents(spark, texts)).collect()}
    assert got == counts(texts)


def test_very_long_words_and_empty_table(spark):
    long = "ab" * 30_000
    texts = [(i, f"{long} {long[:-1]}") for i in range(6)]
    assert rows(variants.op13(documents(spark, texts))) == brute(counts(texts))
    assert variants.op13(documents(spark, texts).limit(0)).count() == 0
    other = documents(spark, texts).withColumn("n", F.lit("x")).withColumn("form", F.lit(1)).withColumn("root", F.lit(2))
    assert rows(variants.op13(other)) == rows(variants.op13(documents(spark, texts)))


def test_what_a_deletion_leaves_is_not_deleted_from_again(spark):
    """Runs of one letter: many lose a code point, and some of what they leave is a run that loses one too."""
    text = " ".join("a" * n for n in range(900, 5, -1))
    chained = [i for i in range(400) if any(all(zlib.crc32(f"{i}:{'a' * m}".encode()) % 199 == 0 for m in (n, n - 1)) for n in range(8, 900))]
    assert chained
    texts = [(i, text) for i in chained[:5] for _ in range(5)]
    got = {r.word: r.n for r in variants.word_counts(documents(spark, texts)).collect()}
    assert got == counts(texts)
