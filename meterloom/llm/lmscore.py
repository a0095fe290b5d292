"""Language-model scoring with a log-frequency Bloom filter of quantised bigram and trigram counts.

Documents are cut into blocks of about ``block_bytes`` of text, written once. Token counts are exact: each block
sends the sorted hashes of its vocabulary with their training counts through ranges of 64-bit hashes; a range adds
them up and answers every block. So a hot word is one number a block, and ranges grow in number with the data.

The filter is built from training rows alone. Blocks send the keys of their bigrams and trigrams with their training counts
to ranges of keys, once; a range adds them up and makes one segment of the filter, of ``bits_per_key`` bits a key. An
n-gram of count ``c`` has the level ``1 + floor(log_base(c))`` and is stored under the keys (n-gram, 1) ... (n-gram,
level), so common n-grams have more bits and a false hit costs one level. Segments grow in number with the data and
hold every level at every size.

Scoring sees segments and the blocks' keys, and no counts of n-grams: a count is read back by probing level after
level until one is missing. The range that made a segment probes the keys it was sent. With ``most_groups`` above 0 segments
are stored instead and broadcast in groups of at most ``group_bytes``, one pass over the blocks a group; where more
groups would be needed, keys and stored segments meet by range. All ways read the same levels.

    P1(w)     = (c(w) + 0.5) / (N + 0.5 (V + 1))
    P2(w|v)   = b * low(v, w) / c(v) + (1 - b) P1(w)                  (P1 after a context never seen)
    P(w|u,v)  = a * low(u, v, w) / high(u, v) + (1 - a) P2(w|v)        (P2 after a context never seen)

``low`` and ``high`` are the least and largest counts of a level, so the probabilities after a context sum to 1 at most
but for false hits. Contexts before a text's first token are end tokens. The weights a and b are those of a grid with the best
likelihood on training rows set aside (one in ``aside``, by a hash), which the filter does not hold; they have blocks of their
own, so the weights are fitted without the others.

Defined results: a null text is empty: its one token is the end; repeated rows count each; ids may be
null or repeated; without training rows N = V = 0; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.llm.common import remainder, stored, tidy
from meterloom.llm.shingles import constants, many_word_hashes, mixed

#: Stands for the end of a text; no word of a text hashes to it but by chance.
END = constants(1, 11)[0]
_PAIR = constants(4, 12)
_PROBE = constants(16, 13)
#: A hash keeps its lowest 40 bits inside its range.
_LOW = np.uint64((1 << 40) - 1)


def _tokens(texts: list[str | None]) -> list[np.ndarray]:
    lowered = [(t or "").encode("utf-8", "replace").lower() for t in texts]
    return [np.append(w, END) for w in many_word_hashes(lowered)]



def _pack40(x: np.ndarray) -> bytes:
    """Byte after byte of all: what is alike compresses."""
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].T.tobytes()


def _unpack40(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 5, 8), np.uint8)
    wide[:, :5] = np.frombuffer(data, np.uint8).reshape(5, -1).T
    return wide.view("<u8").ravel()


def _pack32(x: np.ndarray) -> bytes:
    return x.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpack32(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<i4").ravel()


def token_blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """block, ids, training (how a document is used, a byte each), lengths, vocabulary (sorted hashes), stream (places in it)."""
    kind = dict(docs.dtypes)["doc_id"]

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        # Of the rows set aside (odd numbers) and of the others: number of the next block, ids, training, texts, size.
        open_blocks = {True: [part + 1, [], [], [], 0], False: [part, [], [], [], 0]}

        def made(number: int, ids: list, training: list[int], texts: list[str | None], size: int) -> pa.RecordBatch:
            tokens = _tokens(texts)
            vocabulary, stream = np.unique(np.concatenate(tokens), return_inverse=True)
            columns = [
                pa.array([number], pa.int64()),
                pa.array([ids], pa.list_(id_type)),
                pa.array([np.array(training, np.uint8).tobytes()], pa.binary()),
                pa.array([np.array([len(t) for t in tokens], "<i4").tobytes()], pa.binary()),
                pa.array([vocabulary.astype("<u8").tobytes()], pa.binary()),
                pa.array([stream.astype("<i4").tobytes()], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, ["block", "ids", "training", "lengths", "vocabulary", "stream"])

        id_type = pa.int64()
        for batch in batches:
            id_type = batch.schema.field(0).type
            for doc_id, train, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = open_blocks[train == 2]
                own[1].append(doc_id)
                own[2].append(train)
                own[3].append(text)
                own[4] += len(text or "") + 1
                if own[4] >= block_bytes:
                    yield made(*own)
                    own[:] = own[0] + 2, [], [], [], 0
        for own in open_blocks.values():
            if own[1]:
                yield made(*own)

    ddl = f"block long, ids array<{kind}>, training binary, lengths binary, vocabulary binary, stream binary"
    return docs.mapInArrow(tidy(blocks), ddl)


#: Blocks of the rows set aside.
_ASIDE = "block % 2 = 1"


def _range_cuts(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Where sorted hashes pass from one range of the top ``bits`` to the next."""
    return np.searchsorted(hashes >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))


def vocabulary_parts(blocks: DataFrame, bits: int) -> DataFrame:
    """range, block, hashes and training counts of each block's vocabulary."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            hashes, stream, _, lengths, use = _opened(row)
            counts = np.bincount(stream[np.repeat(use > 0, lengths)], minlength=len(hashes))
            cuts = _range_cuts(hashes, bits)
            full = np.flatnonzero(np.diff(cuts))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(full, pa.int32()),
                    pa.array([row["block"]] * len(full), pa.int64()),
                    pa.array([hashes[cuts[r] : cuts[r + 1]].tobytes() for r in full], pa.binary()),
                    pa.array([counts[cuts[r] : cuts[r + 1]].astype("<i4").tobytes() for r in full], pa.binary()),
                ],
                ["range", "block", "hashes", "counts"],
            )

    return blocks.select(*_BLOCK).mapInArrow(tidy(parts), "range int, block long, hashes binary, counts binary")


def counted_vocabularies(parts: DataFrame) -> DataFrame:
    """block, range, corpus counts of its hashes; the first row of a range has its distinct and all tokens."""

    def added(group: pd.DataFrame) -> pd.DataFrame:
        hashes = [np.frombuffer(x, "<u8") for x in group["hashes"]]
        every, place = np.unique(np.concatenate(hashes), return_inverse=True)
        counts = np.concatenate([np.frombuffer(x, "<i4") for x in group["counts"]])
        total = np.bincount(place, weights=counts, minlength=len(every)).astype("<i8")
        ends = np.cumsum([len(h) for h in hashes])[:-1]
        return pd.DataFrame({
            "block": group["block"],
            "range": group["range"],
            "counts": [total[p].tobytes() for p in np.split(place, ends)],
            "distinct": [int((total > 0).sum())] + [0] * (len(group) - 1),
            "tokens": [int(total.sum())] + [0] * (len(group) - 1),
        })

    return parts.groupBy("range").applyInPandas(added, "block long, range int, counts binary, distinct long, tokens long")


def _keys(hashes: np.ndarray, stream: np.ndarray, starts: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Context place (-1: the end), bigram key and trigram key at each token.

    A key has the range in its top ``bits`` and 40 bits inside it.
    """
    before = np.empty(len(stream), np.int64)
    before[1:] = stream[:-1]
    before[starts] = -1
    context = np.where(before >= 0, hashes[before], END)
    further = np.empty(len(stream), np.uint64)
    further[1:] = context[:-1]
    further[starts] = END
    kept = _LOW | np.uint64(((1 << bits) - 1) << (64 - bits))
    word = hashes[stream]
    two = context * _PAIR[0] + word * _PAIR[1]
    return before, mixed(two) & kept, mixed(two * _PAIR[2] + further * _PAIR[3]) & kept


def _opened(row: dict) -> tuple[np.ndarray, ...]:
    """hashes, stream, first token of each document, lengths, use (0 held out, 1 in the filter, 2 set aside) of a block."""
    hashes = np.frombuffer(row["vocabulary"], "<u8")
    stream, lengths = np.frombuffer(row["stream"], "<i4"), np.frombuffer(row["lengths"], "<i4")
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    return hashes, stream, starts, lengths, np.frombuffer(row["training"], np.uint8)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """A row at a time, so that only one block is held."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(c)[i].as_py() for c, name in enumerate(batch.schema.names)}


_BLOCK = ["block", "training", "lengths", "vocabulary", "stream"]


def key_parts(blocks: DataFrame, bits: int, *, training: bool | None) -> DataFrame:
    """range, block and keys (40 bits, sorted): of training rows with counts, or of all rows without (None: with training counts)."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            hashes, stream, starts, lengths, use = _opened(row)
            _, two, three = _keys(hashes, stream, starts, bits)
            own = np.repeat(use == 1, lengths)
            if training:
                two, three = two[own], three[own]
            found, place = np.unique(np.concatenate((two, three)), return_inverse=True)
            weights = None if training else np.concatenate((own, own))
            n = np.bincount(place, weights=weights, minlength=len(found)).astype("<i8")
            cuts = _range_cuts(found, bits)
            full = np.flatnonzero(np.diff(cuts))
            counts = [_pack32(n[cuts[r] : cuts[r + 1]]) for r in full] if training is not False else [None] * len(full)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(full, pa.int32()),
                    pa.array([row["block"]] * len(full), pa.int64()),
                    pa.array([_pack40(found[cuts[r] : cuts[r + 1]]) for r in full], pa.binary()),
                    pa.array(counts, pa.binary()),
                ],
                ["range", "block", "hashes", "counts"],
            )

    return blocks.select(*_BLOCK).mapInArrow(tidy(parts), "range int, block long, hashes binary, counts binary")


def _levels(counts: np.ndarray, base: float) -> np.ndarray:
    """1 + floor(log_base(count)); 0 for what doesn't occur."""
    logs = np.log(np.maximum(counts, 1)) / math.log(base)
    return np.where(counts > 0, np.minimum(1 + np.floor(logs + 1e-9), 255), 0).astype(np.uint8)


def _positions(hashes: np.ndarray, level: int, size: int, k: int) -> np.ndarray:
    """k bit positions a key (row), by double hashing."""
    x = mixed(hashes ^ np.uint64(int(_PROBE[0]) * level % (1 << 64)))
    a, b = x >> np.uint64(32), (x & np.uint64(0xFFFFFFFF)) | np.uint64(1)
    steps = np.arange(k, dtype=np.uint64)
    return ((a[:, None] + b[:, None] * steps) * _PROBE[1] >> np.uint64(16)) % np.uint64(size)


_SLICE = 1 << 17  # n-grams at a time
_BATCH = 8 << 20  # bytes of the Arrow batches; a block is a row


class Segment:
    """The bits of one range; ``level`` reads quantised counts back."""

    def __init__(self, size: int, k: int, data: bytes) -> None:
        self.size, self.k, self.data = size, k, np.frombuffer(data, np.uint8)

    @classmethod
    def build(cls, hashes: np.ndarray, levels: np.ndarray, *, bits_per_key: int, probes: int) -> Segment:
        """With all levels of the n-grams."""
        size = max(64, int(levels.sum(dtype=np.int64)) * bits_per_key)
        mask = np.zeros(-(-size // 8) * 8, np.uint8)
        for level in range(1, int(levels.max(initial=0)) + 1):
            keys = hashes[levels >= level]
            for i in range(0, len(keys), _SLICE):
                mask[_positions(keys[i : i + _SLICE], level, size, probes).ravel()] = 1
        return cls(size, probes, np.packbits(mask, bitorder="little").tobytes())

    def level(self, hashes: np.ndarray) -> np.ndarray:
        """Of any number of n-grams, a slice at a time."""
        parts = [self._level(hashes[i : i + _SLICE]) for i in range(0, len(hashes), _SLICE)]
        return np.concatenate(parts) if parts else np.zeros(0, np.uint8)

    def _level(self, hashes: np.ndarray) -> np.ndarray:
        out, left, level = np.zeros(len(hashes), np.uint8), np.arange(len(hashes)), 1
        while len(left) and level < 256:
            at = _positions(hashes[left], level, self.size, self.k)
            bits = self.data[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)
            left = left[(bits & 1).all(1)]
            out[left] = level
            level += 1
        return out


def build_segments(parts: DataFrame, base: float, *, bits_per_key: int, probes: int) -> DataFrame:
    """range, size, probes and bits: one segment a range, from the counts of training n-grams."""

    def built(group: pd.DataFrame) -> pd.DataFrame:
        every, place = np.unique(np.concatenate([_unpack40(x) for x in group["hashes"]]), return_inverse=True)
        counts = np.concatenate([_unpack32(x) for x in group["counts"]])
        levels = _levels(np.bincount(place, weights=counts, minlength=len(every)), base)
        made = Segment.build(every, levels, bits_per_key=bits_per_key, probes=probes)
        return pd.DataFrame({"range": group["range"].iloc[:1], "size": [made.size], "probes": [probes], "bits": [made.data.tobytes()]})

    return parts.groupBy("range").applyInPandas(built, "range int, size long, probes int, bits binary")


def build_and_probe(blocks: DataFrame, base: float, bits: int, *, bits_per_key: int, probes: int) -> DataFrame:
    """block, range and levels of the block's sorted keys there: each range makes its segment and probes it."""

    def probed(parts: pa.Table) -> pa.Table:
        hashes = [_unpack40(x.as_py()) for x in parts["hashes"]]
        ends = np.cumsum([len(h) for h in hashes])[:-1]
        every, place = np.unique(np.concatenate(hashes), return_inverse=True)
        del hashes
        counts = np.concatenate([_unpack32(x.as_py()) for x in parts["counts"]])
        levels = _levels(np.bincount(place, weights=counts, minlength=len(every)), base)
        segment = Segment.build(every, levels, bits_per_key=bits_per_key, probes=probes)
        read = segment.level(every)  # a key of several blocks is read once
        found = [x.tobytes() for x in np.split(read[place], ends)]
        return pa.Table.from_batches([_levels_batch(parts["block"].to_pylist(), parts["range"].to_pylist(), found)])

    parts = key_parts(blocks, bits, training=None)
    return stored(parts.groupBy("range").applyInArrow(probed, _LEVELS), "lm-levels", batch_bytes=_BATCH, compression="zstd")


def probe_by_broadcast(blocks: DataFrame, segments: DataFrame, bits: int, group_bytes: int) -> DataFrame:
    """block, range (the first of a group) and levels of the block's sorted keys in that group, a pass a group."""
    spark = blocks.sparkSession
    sizes = sorted((r.range, r.n) for r in segments.select("range", F.octet_length("bits").alias("n")).collect())
    groups, size = [[]], 0  # of ranges that follow each other
    for r, n in sizes:
        if groups[-1] and size + n > group_bytes:
            groups.append([])
            size = 0
        groups[-1].append(r)
        size += n
    # Every range belongs to a group, also those without a segment.
    firsts = [0] + [g[0] for g in groups[1:]]
    ends = firsts[1:] + [1 << bits]
    found = None
    for first, end in zip(firsts, ends, strict=True):
        rows = segments.where((F.col("range") >= first) & (F.col("range") < end)).collect()
        sent = spark.sparkContext.broadcast([(r.range, r.size, r.probes, bytes(r.bits)) for r in rows])

        def probed(batches: Iterator[pa.RecordBatch], first=first, end=end, sent=sent) -> Iterator[pa.RecordBatch]:
            own = {r: Segment(size, k, data) for r, size, k, data in sent.value}
            for row in _rows(batches):
                hashes, stream, starts, _, _ = _opened(row)
                _, two, three = _keys(hashes, stream, starts, bits)
                keys = np.unique(np.concatenate((two, three)))
                cuts = _range_cuts(keys, bits)
                levels = [
                    own[r].level(keys[cuts[r] : cuts[r + 1]] & _LOW) if r in own else np.zeros(cuts[r + 1] - cuts[r], np.uint8)
                    for r in range(first, end)
                ]
                yield _levels_batch([row["block"]], [first], [np.concatenate(levels).tobytes()])

        part = stored(blocks.select(*_BLOCK).mapInArrow(tidy(probed), _LEVELS), "lm-levels", batch_bytes=_BATCH, compression="zstd")
        sent.unpersist()
        found = part if found is None else found.union(part)
    return found


_LEVELS = "block long, range int, levels binary"


def _levels_batch(block: list, first: list, levels: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(block, pa.int64()), pa.array(first, pa.int32()), pa.array(levels, pa.binary())], ["block", "range", "levels"]
    )


def probe_by_range(blocks: DataFrame, segments: DataFrame, bits: int) -> DataFrame:
    """block, range and levels of the block's sorted keys there: keys and segments meet by range."""

    def probed(keys: pa.Table, own: pa.Table) -> pa.Table:
        segment = Segment(own["size"][0].as_py(), own["probes"][0].as_py(), own["bits"][0].as_py()) if own.num_rows else None
        levels = []
        for x in keys["hashes"]:
            hashes = _unpack40(x.as_py())
            levels.append((segment.level(hashes) if segment else np.zeros(len(hashes), np.uint8)).tobytes())
        return pa.Table.from_batches([_levels_batch(keys["block"].to_pylist(), keys["range"].to_pylist(), levels)])

    parts = key_parts(blocks, bits, training=False).drop("counts")
    met = parts.groupBy("range").cogroup(segments.groupBy("range")).applyInArrow(probed, _LEVELS)
    return stored(met, "lm-levels", batch_bytes=_BATCH, compression="zstd")


def _token_terms(row: dict, bits: int, base: float, spread: float) -> tuple[np.ndarray, ...]:
    """first token of each document, lengths, use, counts, P1, and the ratios of bigrams and trigrams (-1: no context)."""
    hashes, stream, starts, lengths, use = _opened(row)
    before, two, three = _keys(hashes, stream, starts, bits)
    counts = np.frombuffer(b"".join(row["counts"]), "<i8")
    # Ranges and what is inside them have the order of the keys.
    places = np.unique(np.concatenate((two, three)), return_inverse=True)[1]
    levels = np.frombuffer(b"".join(row["levels"]), np.uint8)[places]
    level2, level3 = levels[: len(two)].astype(np.float64), levels[len(two) :].astype(np.float64)
    c = counts[stream]
    end = np.searchsorted(hashes, END)  # every block has the end
    context = counts[np.where(before < 0, end, before)]
    low = lambda level: np.where(level > 0, np.ceil(base ** (level - 1.0) - 1e-9), 0)
    low2 = np.minimum(low(level2), np.minimum(c, context))
    ratio2 = np.where(context > 0, low2 / np.maximum(context, 1), -1.0)
    # The context pair is the bigram that ends one token before; after a text's start there is none.
    pair = np.zeros(len(stream))
    pair[1:] = level2[:-1]
    pair[starts] = 0
    high = np.maximum(np.ceil(base**pair - 1e-9) - 1, 1)
    ratio3 = np.where(pair > 0, np.minimum(low(level3), high) / high, -1.0)
    return starts, lengths, use, c, (c + 0.5) / spread, ratio2, ratio3


def _mixed_logs(one: np.ndarray, ratio2: np.ndarray, ratio3: np.ndarray, a: float, b: float) -> np.ndarray:
    two = np.where(ratio2 >= 0, b * np.maximum(ratio2, 0) + (1 - b) * one, one)
    return np.log10(np.where(ratio3 >= 0, a * np.maximum(ratio3, 0) + (1 - a) * two, two))


#: Weights (a, b) of trigrams and bigrams that are tried.
GRID = [(a, b) for a in (0.0, 0.05, 0.1, 0.2, 0.3, 0.45, 0.6) for b in (0.0, 0.05, 0.1, 0.2, 0.3, 0.45, 0.6, 0.75)]


def best_weights(answered: DataFrame, spread: float, *, bits: int, base: float) -> tuple[float, float]:
    """The weights with the best likelihood of the rows set aside; (0.1, 0.2) without any."""

    def tried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(len(GRID)), 0
        for row in _rows(batches):
            _, lengths, use, _, one, ratio2, ratio3 = _token_terms(row, bits, base, spread)
            own = np.repeat(use == 2, lengths)
            seen += int(own.sum())
            if own.any():
                total += [_mixed_logs(one[own], ratio2[own], ratio3[own], a, b).sum() for a, b in GRID]
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(GRID)), pa.int32()), pa.array(total)], ["place", "total"])

    sums = answered.mapInArrow(tidy(tried), "place int, total double").groupBy("place").agg(F.sum("total").alias("total"))
    found = stored(sums, "lm-weights", batch_bytes=_BATCH).collect()  # a row a grid point
    return GRID[max(found, key=lambda r: (r.total, -r.place)).place] if found else (0.1, 0.2)


def scored(answered: DataFrame, spread: float, weights: tuple[float, float], *, bits: int, base: float, kind: str) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, base_score and score of every document of the blocks with counts and levels."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            id_type = batch.schema.field("ids").type.value_type
            for row in _rows([batch]):
                starts, lengths, use, c, one, ratio2, ratio3 = _token_terms(row, bits, base, spread)
                logs = _mixed_logs(one, ratio2, ratio3, *weights)
                per = lambda x: np.add.reduceat(x, starts)  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["ids"], id_type), pa.array(use == 0), pa.array(lengths.astype(np.int64)),
                        pa.array(per((c > 0).astype(np.int64))), pa.array(per(np.log10(one))), pa.array(per(logs)),
                    ],
                    ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"],
                )

    ddl = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    return stored(answered.mapInArrow(tidy(rows), ddl), "lm-scores", batch_bytes=_BATCH)


def _bits(rows: int, row_bytes: float, group_bytes: int = 16 << 20) -> int:
    """Top bits that cut so many rows into ranges of about ``group_bytes``, at least 64 ranges."""
    return max(6, math.ceil(math.log2(max(1, rows * row_bytes / group_bytes))))


def score_texts(
    docs: DataFrame,
    training,
    *,
    base: float = 2.0,
    aside: int = 20,
    bits_per_key: int = 12,
    probes: int = 5,
    segment_bytes: int = 4 << 20,
    group_bytes: int = 32 << 20,
    most_groups: int = 0,
    block_bytes: int = 4 << 20,
) -> DataFrame:
    """Scores every text by a model of the rows where the column ``training`` holds.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score.
    """
    kind = dict(docs.dtypes)["doc_id"]
    apart = F.pmod(F.xxhash64("doc_id", "text", F.lit(5)), F.lit(aside)) == 0
    use = F.when(~F.coalesce(training, F.lit(False)), 0).when(apart, 2).otherwise(1).cast("int")
    rows = docs.select("doc_id", use.alias("training"), "text")
    blocks = stored(token_blocks(rows, block_bytes), "lm-blocks", compression="zstd", batch_bytes=_BATCH)
    sizes = blocks.agg(F.sum(F.octet_length("vocabulary")), F.sum(F.octet_length("stream"))).first()
    parts = vocabulary_parts(blocks, _bits((sizes[0] or 0) // 8, 12))
    counts = stored(counted_vocabularies(parts), "lm-counts", compression="zstd", batch_bytes=_BATCH)
    distinct, tokens = (x or 0 for x in counts.agg(F.sum("distinct"), F.sum("tokens")).first())

    # Two keys a token at most, of bits_per_key bits a level; levels above the first are few.
    bits = _bits((sizes[1] or 0) // 2, max(9, bits_per_key / 8), segment_bytes * 6)
    if most_groups <= 0:
        levels = build_and_probe(blocks, base, bits, bits_per_key=bits_per_key, probes=probes)
    else:
        segments = build_segments(key_parts(blocks, bits, training=True), base, bits_per_key=bits_per_key, probes=probes)
        segments = stored(segments, "lm-segments", batch_bytes=_BATCH)
        size = segments.agg(F.sum(F.octet_length("bits"))).first()[0] or 0
        if size <= most_groups * group_bytes:
            levels = probe_by_broadcast(blocks, segments, bits, group_bytes)
        else:
            levels = probe_by_range(blocks, segments, bits)

    own = lambda rows, name: rows.groupBy("block").agg(  # as many entries as ranges
        F.sort_array(F.collect_list(F.struct("range", name))).alias("parts")
    ).select("block", F.col(f"parts.{name}").alias(name))

    def answered(some: str) -> DataFrame:
        told = own(counts.where(some), "counts"), own(levels.where(some), "levels")
        return blocks.where(some).join(told[0], "block").join(told[1], "block")

    spread = tokens + 0.5 * (distinct + 1)
    weights = best_weights(answered(_ASIDE), spread, bits=bits, base=base)
    out = scored(answered("true"), spread, weights, bits=bits, base=base, kind=kind)
    return out.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )


def op9(docs: DataFrame) -> DataFrame:
    return score_texts(docs, remainder(F.col("doc_id"), 5) != 1)
