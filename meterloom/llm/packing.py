"""Packing: order-preserving dynamic programming over cut points.

Documents are encoded and ended by one id; the stream of a task keeps the stored order of its rows, so
nothing is shuffled. The stream may be cut after a document (free), after a sentence (``sentence_cost``)
and, inside a sentence longer than ``grid`` tokens, on a grid (``hard_cost``). Costs count in tokens of
padding. With ``marks`` the cut points, the cheapest way to end a sequence at mark ``j`` is

    f[j] = cost[j] + capacity - marks[j] + min(f[i] + marks[i])   over marks[j] - marks[i] <= capacity

and the minimum over that sliding window comes from a monotone queue: linear in the marks. The stream
is planned in blocks of ``block_tokens``; the last sequence of a block is planned again with the next
one, so only the last sequence of a task is left to its own length.

Output, one row a piece: doc_id, start, length, doc_tokens, sequence_id, offset and tokens (its ids as
unsigned little-endian 32-bit numbers). Pieces of a sequence follow each other without gaps.

Defined results: a null or empty text is the end id alone; repeated rows are documents of their own;
a null doc_id stays null; texts longer than a sequence go over several; an empty table gives no rows;
only the named columns are read.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.llm.common import tidy
from meterloom.llm.tokens import encoder


def choose_cuts(marks: list[int], costs: list[int], capacity: int) -> list[int]:
    """Positions where the cheapest sequences end; the first mark is the start, the last the end.

    Neighbouring marks must be at most ``capacity`` apart.
    """
    best, back = [0] * len(marks), [0] * len(marks)
    queue = deque([(marks[0], 0)])  # (best[i] + marks[i], i), rising
    for j in range(1, len(marks)):
        mark = marks[j]
        least = mark - capacity
        while marks[queue[0][1]] < least:
            queue.popleft()
        value, back[j] = queue[0]
        best[j] = here = value + costs[j] + capacity - mark
        here += mark
        while queue and queue[-1][0] >= here:
            queue.pop()
        queue.append((here, j))
    cuts, j = [], len(marks) - 1
    while j:
        cuts.append(marks[j])
        j = back[j]
    return cuts[::-1]


def cut_points(
    ids: np.ndarray, doc_ends: np.ndarray, sentence_end: np.ndarray, capacity: int, sentence_cost: int, hard_cost: int, grid: int
) -> tuple[list[int], list[int]]:
    """Marks and costs of a stream; ``doc_ends`` are positions after documents. The stream's ends are marks."""
    cost = np.full(len(ids) + 1, -1, np.int32)
    cost[np.flatnonzero(sentence_end[ids]) + 1] = sentence_cost
    cost[-1] = hard_cost
    cost[doc_ends] = 0
    cost[0] = 0
    marks = np.flatnonzero(cost >= 0)
    gaps = np.diff(marks)
    for i in np.flatnonzero(gaps > grid):  # long sentences only
        cost[marks[i] + grid : marks[i + 1] : grid] = hard_cost
    marks = np.flatnonzero(cost >= 0)
    return marks.tolist(), cost[marks].tolist()


class _Stream:
    """The documents of a task that have not been given out yet."""

    def __init__(self) -> None:
        self.parts: list[tuple] = []  # doc_id, start, ids, doc_tokens, whether the document ends here
        self.tokens = 0

    def add(self, doc_id, start: int, ids: np.ndarray, doc_tokens: int, ends: bool) -> None:
        self.parts.append((doc_id, start, ids, doc_tokens, ends))
        self.tokens += len(ids)


def pack(
    docs: DataFrame,
    tokenizer: str,
    *,
    capacity: int = 2048,
    end_id: int = 1,
    sentence_cost: int = 4,
    hard_cost: int = 32,
    grid: int = 64,
    block_tokens: int = 1_000_000,
) -> DataFrame:
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(tokenizer)
        sentence_end = words.sentence_end
        stream, sequence = _Stream(), TaskContext.get().partitionId() << 40
        end = np.asarray([end_id], "<u4")

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal stream, sequence
            ids = np.concatenate([p[2] for p in stream.parts])
            ends = np.cumsum([len(p[2]) for p in stream.parts])
            doc_ends = ends[[p[4] for p in stream.parts]]
            marks, costs = cut_points(ids, doc_ends, sentence_end, capacity, sentence_cost, hard_cost, grid)
            cuts = choose_cuts(marks, costs, capacity)
            keep = cuts if last or len(cuts) < 2 else cuts[:-1]
            rest, rows, at, k = _Stream(), [], 0, 0
            begin = 0  # of the sequence
            for doc_id, start, own, doc_tokens, closes in stream.parts:
                done, stop = at, at + len(own)
                while done < stop and k < len(keep):
                    upto = min(stop, keep[k])
                    piece = own[done - at : upto - at]
                    rows.append((doc_id, start + done - at, len(piece), doc_tokens, sequence, done - begin, piece.tobytes()))
                    done = upto
                    if done == keep[k]:
                        begin, sequence, k = done, sequence + 1, k + 1
                if done < stop:
                    rest.add(doc_id, start + done - at, own[done - at :].copy(), doc_tokens, closes)
                at = stop
            stream = rest
            for i in range(0, len(rows), 4096):
                columns = list(zip(*rows[i : i + 4096], strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], ids_type)]
                    + [pa.array(c, pa.int64()) for c in columns[1:6]]
                    + [pa.array(columns[6], pa.binary())],
                    ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "tokens"],
                )

        ids_type = pa.int64()
        for batch in batches:
            ids_type = batch.schema.field(0).type
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.concatenate((words.ids(text.as_py() or ""), end))
                for a in range(0, len(ids), block_tokens):
                    part = ids[a : a + block_tokens]
                    stream.add(doc_id, a, part, len(ids), a + len(part) == len(ids))
                    if stream.tokens >= block_tokens:
                        yield from flush(last=False)
        if stream.parts:
            yield from flush(last=True)

    kind = dict(docs.dtypes)["doc_id"]
    ddl = f"doc_id {kind}, start long, length long, doc_tokens long, sequence_id long, offset long, tokens binary"
    return docs.select("doc_id", "text").mapInArrow(tidy(pieces), ddl)


def op1(docs: DataFrame, tokenizer: str) -> DataFrame:
    return pack(docs, tokenizer).select(
        "doc_id", "start", "length", F.crc32("tokens").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
