import random
import zlib
from collections import Counter, defaultdict

from meterloom.llm import sharding
from tests.llm.cases import awkward, documents, prose


def check(rows, texts, shards):
    assert Counter((r.doc_id, r.size) for r in rows) == Counter((i, len((t or "").encode()) + 8) for i, t in texts)
    slots, groups = defaultdict(list), defaultdict(set)
    by_id = {i: t for i, t in texts}
    for r in rows:
        assert 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
    for own in slots.values():
        assert sorted(own) == list(range(len(own)))
    for r in rows:
        if list(i for i, _ in texts).count(r.doc_id) == 1:
            text = by_id[r.doc_id]
            assert r.text_crc32 == zlib.crc32((text or "").encode())
            groups[text].add(r.shard)
    assert all(len(s) == 1 for s in groups.values())


def test_lpt_is_the_greedy_schedule():
    draw = random.Random(4)
    for _ in range(50):
        sizes = [(i, draw.randint(1, 30)) for i in range(40)]
        loads = [0] * 5
        for size, item in sorted(((s, i) for i, s in sizes), key=lambda x: (-x[0], x[1])):
            loads[loads.index(min(loads))] += size
        placed = sharding.lpt(sizes, 5)
        got = Counter()
        for i, s in sizes:
            got[placed[i]] += s
        assert sorted(got.values()) == sorted(loads)


def test_even_bytes_whole_groups_and_gapless_slots(spark):
    texts = [(i, prose(i % 700, 5 + i % 90)) for i in range(1000)] + [(5000 + i, prose(3, 30)) for i in range(40)]
    rows = sharding.op7(documents(spark, texts)).collect()
    check(rows, texts, 24)
    loads = Counter()
    for r in rows:
        loads[r.shard] += r.size
    assert max(loads.values()) - min(loads.values()) < 0.05 * sum(loads.values()) / 24
    assert {(r.law, r.grown_shard) for r in rows} == {("bytes", None)}


def test_bundles_hold_for_many_groups(spark):
    texts = [(i, prose(i, 8)) for i in range(1500)]
    rows = sharding.assign_shards(documents(spark, texts), 4, bundles=16, heavy=4, pieces=3).collect()
    check(rows, texts, 4)
    loads = Counter()
    for r in rows:
        loads[r.shard] += r.size
    assert max(loads.values()) < 1.1 * min(loads.values())


def test_awkward_rows(spark):
    texts = awkward()
    check(sharding.op7(documents(spark, texts)).collect(), texts, 24)
    assert sharding.op7(documents(spark, texts).limit(0)).count() == 0


def test_written_shards_hold_their_documents(spark, tmp_path):
    docs = documents(spark, [(i, prose(i, 20)) for i in range(50)])
    plan = sharding.assign_shards(docs.select("doc_id", "text"), 3)
    sharding.write_shards(docs, plan, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r.doc_id, r.shard) for r in back.collect()) == sorted((r.doc_id, r.shard) for r in plan.collect())


def test_written_shards_hold_every_row_once(spark, tmp_path):
    """Null and repeated ids, repeated rows, null texts, clashing names."""
    texts = awkward() + [(7, prose(3, 9))] * 5 + [(None, prose(i % 3, 9)) for i in range(6)]
    docs = documents(spark, texts)
    sharding.write_shards(docs, sharding.assign_shards(docs, 3), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(back.columns) == sorted(docs.columns)
    assert Counter((r.doc_id, r.text, r.words) for r in back.collect()) == Counter((i, t, "x") for i, t in texts)


def test_one_row_many_times_is_dealt_over_the_pieces(spark):
    docs = documents(spark, [(1, "same text")] * 600)
    rows = sharding.assign_shards(docs, 2, pieces=8).collect()
    assert len({r.shard for r in rows}) == 1 and sorted(r.slot for r in rows) == list(range(600))
    stored = sharding.stored(sharding.measured(docs.repartition(3)), "rows")
    placed = stored.selectExpr("pmod(xxhash64(doc_id, text_crc32, xxhash64(_metadata.file_name, _metadata.row_index)), 8) AS piece")
    assert placed.distinct().count() == 8
