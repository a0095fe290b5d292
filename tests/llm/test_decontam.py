import itertools
import math
import random
import re

import pytest

from meterloom.llm import decontam
from tests.llm.cases import awkward, documents, prose


def words(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def best(doc, item, shift):
    same = [int(doc[shift + q] == item[q]) for q in range(len(item)) if 0 <= shift + q < len(doc)]
    width = min(20, len(item))
    if len(same) < min(8, len(item)):
        return 0, width
    return max((sum(same[i : i + width]) for i in range(max(1, len(same) - width + 1)))), width


def brute(docs, items):
    """Every shift of every item over every document; items of fewer than five words against whole documents."""
    found = {}
    for d, text in docs:
        doc = words(text)
        for i, other in items:
            item = words(other)
            if len(item) < 5:
                if item and doc == item:
                    found[d, i] = len(item)
                continue
            for shift in range(-len(item) + 1, len(doc)):
                matched, width = best(doc, item, shift)
                if matched >= max(math.ceil(width * 0.8 - 1e-9), min(8, len(item))):
                    found[d, i] = max(found.get((d, i), 0), matched)
    return found


def substituted(text, every, offset):
    return " ".join(f"q{i}" if i % every == offset else w for i, w in enumerate(text.split()))


@pytest.fixture(scope="module")
def tables(spark):
    items = [(i, prose(900 + i, 12 + 5 * i)) for i in range(8)] + [(50, "too short to say anything"), (51, None), (52, ""), (53, "only three words")]
    texts = []
    for i in range(8):
        item = items[i][1]
        texts += [(100 + i, f"{prose(i, 30)} {item} {prose(i + 50, 20)}"), (200 + i, item.upper().replace(" ", " -- "))]
        texts += [(300 + 10 * i + k, f"{prose(i, 9)} {substituted(item, 5, k)}") for k in range(5)]
        texts += [(400 + i, " ".join(item.split()[: len(item.split()) // 2]))]
    texts += [(500, "and TOO short, to say anything at all"), (501, "too short to say nothing"), (502, "Only three words."), (503, "only three words here")]
    texts += [(1000 + i, prose(2000 + i, 80)) for i in range(40)]
    draw = random.Random(8)
    texts += [(1100 + i, " ".join(draw.sample(items[7][1].split(), 40))) for i in range(10)]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, words string")
    return texts, items, documents(spark, texts), bench


def test_pairs_equal_brute_force(tables):
    texts, items, docs, bench = tables
    want = brute(texts, items)
    got = {(r.doc_id, r.item_id): r.matched for r in decontam.op10(docs, bench).collect()}
    assert {(d, i) for d, i in want if d < 300} <= set(got)
    assert set(got) <= set(want) and all(got[k] == want[k] for k in got)
    assert len(set(want) - set(got)) <= 0.02 * len(want)
    assert not any(d >= 1000 for d, _ in got)


def test_blocks_of_the_query_set_change_nothing(tables):
    _, _, docs, bench = tables
    whole = sorted(decontam.contaminated(docs, bench).collect())
    assert sorted(decontam.contaminated(docs, bench, block=100).collect()) == whole


def test_clean_documents_stay(tables):
    _, _, docs, bench = tables
    kept = decontam.decontaminated(docs, bench)
    assert kept.columns == docs.columns
    gone = {r.doc_id for r in decontam.op10(docs, bench).collect()}
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()} - gone


def test_rows_without_or_with_one_id_are_judged_by_their_own_text(spark, tables):
    *_, items, _, bench = tables
    hit, clean = f"{prose(1, 9)} {items[3][1]}", [prose(3000 + i, 30 + i) for i in range(12)]
    # The clean texts share some words with the item at the same places, so that both have the hit's shift.
    head = " ".join(items[3][1].split()[:6])
    near = [f"{prose(1, 9)} {head} {prose(4000 + i, 40)}" for i in range(7)]
    texts = [(i, t) for i in (None, 7) for t in [*near[:3], *clean, hit, *near[3:], hit, None]]
    docs = documents(spark, texts)
    assert {(r.doc_id, r.item_id) for r in decontam.op10(docs, bench).collect()} == {(None, 3), (7, 3)}
    kept = sorted((r.doc_id or 0, r.text or "") for r in decontam.decontaminated(docs, bench).collect())
    assert kept == sorted((i or 0, t or "") for i, t in texts if t != hit)


def test_awkward_rows(spark, tables):
    *_, bench = tables
    docs = documents(spark, awkward())
    assert decontam.op10(docs, bench).count() == 0
    assert decontam.decontaminated(docs, bench).count() == len(awkward())
    assert decontam.op10(docs.limit(0), bench).count() == 0
    assert decontam.op10(docs, bench.limit(0)).count() == 0
    item = prose(900, 30)
    null_id = documents(spark, [(None, item), (1, item), (1, item)])
    items = spark.createDataFrame([(1, item), (1, item), (None, item)], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontam.op10(null_id, items).collect()} == {(None, 1), (None, None), (1, 1), (1, None)}
    assert decontam.decontaminated(null_id, items).count() == 0


def seed_is_shared(item, doc):
    """By the masks as the operator uses them, over word lists that are aligned."""
    masks = decontam.MASKS + (decontam.LIGHT_MASKS if len(item) <= decontam.SHORT else ())
    return any(
        all(bit == "0" or item[at + k] == doc[at + k] for k, bit in enumerate(mask))
        for mask in masks for at in range(len(item) - len(mask) + 1)
    )


@pytest.mark.parametrize("n, least", [(n, 1.0) for n in range(8, 15)] + [(15, 0.98)] + [(n, 1.0) for n in range(16, 20)] + [(20, 0.998)])
def test_recall_over_all_placements(n, least):
    """Of as many substitutions as still count as a match, at every place that they can have."""
    item = list(range(n))
    allowed = n - max(math.ceil(n * 0.8 - 1e-9), 8)
    placed = list(itertools.combinations(range(n), allowed))
    found = sum(seed_is_shared(item, [-1 if k in bad else k for k in item]) for bad in placed)
    assert found / len(placed) >= least


def test_ten_word_items_with_two_substitutions(spark):
    """All 45 placements through the operator."""
    item = prose(77, 10, "zi qo wu pel gar").split()
    texts = []
    for i, bad in enumerate(itertools.combinations(range(10), 2)):
        texts.append((i, " ".join([*prose(i, 6).split(), *("sub" if k in bad else w for k, w in enumerate(item)), *prose(i + 99, 6).split()])))
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    assert {r.doc_id for r in decontam.op10(documents(spark, texts), bench).collect()} == set(range(45))
