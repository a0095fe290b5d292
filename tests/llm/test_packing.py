import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from meterloom.llm import packing
from meterloom.llm.queries import word_tokenizer
from meterloom.llm.tokens import Encoder
from tests.llm.cases import awkward, documents, prose


def test_cuts_are_the_cheapest():
    draw = random.Random(3)
    for _ in range(200):
        marks = [0]
        for _ in range(draw.randint(1, 30)):
            marks.append(marks[-1] + draw.randint(1, 10))
        costs, capacity = [0] + [draw.choice([0, 3, 8]) for _ in marks[1:]], draw.randint(10, 25)
        best = [0] + [10**9] * (len(marks) - 1)
        for j in range(1, len(marks)):
            for i in range(j):
                if marks[j] - marks[i] <= capacity:
                    best[j] = min(best[j], best[i] + capacity - marks[j] + marks[i] + costs[j])
        cuts, cost, at = packing.choose_cuts(marks, costs, capacity), 0, 0
        for cut in cuts:
            assert cut - at <= capacity
            cost, at = cost + capacity - cut + at + costs[marks.index(cut)], cut
        assert at == marks[-1] and cost == best[-1]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(word_tokenizer())


@pytest.mark.parametrize(
    "text",
    ["", "İstanbul don't we'll 'S", "naïve café ﬁ <|endoftext|> x", "a\x1cb\x85c d", "ΑΣ ΑΣ.", "½²³ 10km", "é é", "’s it’s it's",
     "\xad soft\xadhyphen", "Ⱥx 日本語 text", "_under_score__ ''s '' 'sx", "x" * 3000, "ͅ ǅ ᾳ", "a—b…c “q” €5"],
)
def test_ids_equal_the_tokenizers(tokenizer, text):
    encoder = Encoder(word_tokenizer())
    assert encoder.by_table
    assert encoder.ids(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_a_full_table_still_gives_all_ids(tokenizer, monkeypatch):
    monkeypatch.setattr("meterloom.llm.tokens.TABLE", 40)
    encoder = Encoder(word_tokenizer())
    for seed in range(5):
        text = prose(seed, 60 + 40 * seed)
        assert encoder.ids(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("capacity, block", [(64, 500), (2048, 1_000_000)])
def test_every_id_lies_in_one_piece(spark, tokenizer, capacity, block):
    texts = awkward() + [(100 + i, prose(i, 10 * i)) for i in range(30)]
    pieces = packing.pack(documents(spark, texts), word_tokenizer(), capacity=capacity, block_tokens=block).toPandas()
    expected = defaultdict(list)
    for doc_id, text in texts:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        expected[doc_id if doc_id is not None else -1].append(ids)
    got = defaultdict(list)
    sequences = defaultdict(list)
    for p in pieces.itertuples():
        ids = np.frombuffer(p.tokens, "<u4")
        key = -1 if p.doc_id != p.doc_id else int(p.doc_id)
        assert len(ids) == p.length and p.length > 0
        assert any(len(e) == p.doc_tokens and (e[p.start : p.start + p.length] == ids).all() for e in expected[key])
        got[key].append((p.start, p.length))
        sequences[p.sequence_id].append((p.offset, p.length))
    for key, wanted in expected.items():
        assert sum(n for _, n in got[key]) == sum(map(len, wanted))
    for own in sequences.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= capacity


def test_digest_and_padding(spark):
    docs = documents(spark, [(i, prose(i, 40 + 13 * (i % 60))) for i in range(600)]).coalesce(1)
    rows = packing.op1(docs, word_tokenizer()).toPandas()
    used = rows.groupby("sequence_id").length.sum()
    assert used.max() <= 2048 and used.sum() / (2048 * len(used)) > 0.97
    whole = packing.pack(docs, word_tokenizer()).toPandas()
    assert {zlib.crc32(t) for t in whole.tokens} == set(rows.ids_crc32)
    assert packing.op1(docs.limit(0), word_tokenizer()).count() == 0
