"""Phrase collocations by weighted acyclic automata.

1. A task splits its texts into pieces and words and counts, language by language, all runs of one to three words
   of a shard of at most ``block_tokens`` words. Words are symbols: 64-bit hashes. From the sorted n-grams it builds
   count transducers, range after range: acyclic automata whose path spells an n-gram and whose last arc has its
   count as output. Levels are built from the deepest up, and states with equal arcs (symbol, count, target) become
   one, as the many states do that follow a rare pair.
2. Ranges are intervals of the order of (first word, second word), so an n-gram and its prefixes but for single
   words lie in one range, and a word that a third of all n-grams start with spans many. Splitters are
   quantiles of a sample of the documents; they only balance the work. Ranges grow in number with the data.
3. For each language and range the transducers of all shards are united and their weights added; what occurs less
   than ``least`` times goes, for neither a candidate nor a part of one occurs less often than the candidate.
4. Candidates are the paths of two and three words. The counts of their parts come from composing the parts with
   the united transducer of the part's range; so many lookups at a time meet one copy of it, which splits
   words that many candidates share.
5. Scores are exact: decimals of 38 digits hold them up to counts of 10^16 in numerator and denominator. Dropping and
   ranking are joins and a window that Spark limits before it shuffles.

Two different words share a hash once in 2^64, in which case their counts would be added.

Defined results: a null or empty text has no words and a null language is ``und``; repeated rows count each;
n-grams that occur less than ``least`` times yield nothing; phrases of equal score and count are in UTF-8 byte order; words may
be of any length; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterloom.llm.common import stored, tidy
from meterloom.llm.shingles import constants, mixed

_PIECES = re.compile(rb"[.,;:!?\n-\r]+")
_MIX = constants(8, 21)
_ZERO = np.zeros(0, np.int64)


class _Vocabulary(dict):
    """Words by order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _symbol(word: bytes) -> int:
    """Zero marks the end of a shorter n-gram."""
    return xxhash.xxh3_64_intdigest(word) or 1


@dataclass
class Shard:
    """Words (with hashes, in their order) and the n-grams of a block as codes of them, with counts, all sorted."""

    words: list[bytes]
    table: np.ndarray
    one: np.ndarray
    two: np.ndarray
    two_n: np.ndarray
    three: np.ndarray
    three_n: np.ndarray


def shard(vocabulary: dict[bytes, int], stream: np.ndarray) -> Shard:
    """Of at most 2^21 words; -1 in the stream ends a piece."""
    words = list(vocabulary)
    hashes = np.fromiter(map(_symbol, words), np.uint64, len(words))
    order = np.argsort(hashes)
    place = np.empty(len(words), np.int64)
    place[order] = np.arange(len(words))
    r = np.where(stream >= 0, place[stream], -1)
    v = len(words)
    pair = (r[:-1] >= 0) & (r[1:] >= 0)
    codes = r[:-1] * v + r[1:]
    two, two_n = np.unique(codes[pair], return_counts=True)
    triple = pair[:-1] & pair[1:]
    three, three_n = np.unique(codes[:-1][triple] * v + r[2:][triple], return_counts=True)
    one = np.bincount(r[r >= 0], minlength=v)
    return Shard([words[i] for i in order], hashes[order], one, two, two_n, three, three_n)


def _place(first: np.ndarray, second: np.ndarray | int = 0) -> np.ndarray:
    """A number that rises with (first, second): 40 bits of the first and 24 of the second."""
    return (first >> np.uint64(24) << np.uint64(24)) | (second >> np.uint64(40) if isinstance(second, np.ndarray) else np.uint64(second))


def _states(symbol: np.ndarray, weight: np.ndarray, to: np.ndarray, parent: np.ndarray, parents: int) -> tuple:
    """States of one level, equal ones merged: of each parent (-1: no arcs), begin and end in the arcs, the arcs kept."""
    arcs = np.bincount(parent, minlength=parents)
    has = np.flatnonzero(arcs)
    start = np.concatenate(([0], np.cumsum(arcs)[:-1]))[has]
    state = np.full(parents, -1, np.int64)
    if not len(has):
        return state, _ZERO, _ZERO, _ZERO
    with np.errstate(over="ignore"):
        row = symbol * _MIX[0] + weight.astype(np.uint64) * _MIX[1] + to.astype(np.uint64) * _MIX[2]
        marks = [np.add.reduceat(mixed(row + m), start) for m in _MIX[3:5]]
    _, first, which = np.unique(marks[0], return_index=True, return_inverse=True)
    same = (marks[1] == marks[1][first][which]) & (arcs[has] == arcs[has][first][which])
    if not same.all():  # once in 2^64: keep them all
        first = which = np.arange(len(has))
    state[has] = which
    length = arcs[has][first]
    end = np.cumsum(length)
    kept = np.repeat(start[first] - (end - length), length) + np.arange(length.sum())
    return state, end - length, end, kept


@dataclass
class Transducer:
    """Root arcs (symbol, count, state), the arcs of states after one word, and those of states after two."""

    first: np.ndarray
    first_n: np.ndarray
    first_to: np.ndarray
    begin1: np.ndarray
    end1: np.ndarray
    second: np.ndarray
    second_n: np.ndarray
    second_to: np.ndarray
    begin2: np.ndarray
    end2: np.ndarray
    third: np.ndarray
    third_n: np.ndarray

    @classmethod
    def build(cls, table: np.ndarray, one: tuple, two: tuple, three: tuple) -> Transducer:
        """From sorted n-grams: (codes, counts) of words, (codes, codes, counts) of pairs, three codes and counts of triples."""
        (a1, n1), (a2, b2, n2), (a3, b3, c3, n3) = one, two, three
        width = np.int64(len(table))
        up2 = np.searchsorted(a2 * width + b2, a3 * width + b3)
        state2, begin2, end2, kept2 = _states(table[c3], n3, np.zeros(len(c3), np.int64), up2, len(a2))
        roots = np.union1d(a1, a2)
        up1 = np.searchsorted(roots, a2)
        state1, begin1, end1, kept1 = _states(table[b2], n2, state2 + 1, up1, len(roots))
        count = np.zeros(len(roots), np.int64)
        count[np.searchsorted(roots, a1)] = n1
        return cls(
            table[roots], count, state1, begin1, end1, table[b2][kept1], n2[kept1], state2[kept1], begin2, end2,
            table[c3][kept2], n3[kept2],
        )

    def pack(self) -> bytes:
        arrays = [np.ascontiguousarray(x, np.uint64 if x.dtype == np.uint64 else np.int64) for x in self.__dict__.values()]
        # Byte after byte of all: small numbers compress.
        return np.array([len(x) for x in arrays], "<i8").tobytes() + b"".join(x.view(np.uint8).reshape(-1, 8).T.tobytes() for x in arrays)

    @classmethod
    def unpack(cls, data: bytes) -> Transducer:
        sizes, at, arrays = np.frombuffer(data, "<i8", 12), 96, []
        for name, n in zip(cls.__dataclass_fields__, sizes.tolist(), strict=True):
            raw = np.frombuffer(data, np.uint8, 8 * n, at).reshape(8, -1).T
            arrays.append(np.ascontiguousarray(raw).view(np.uint64 if name in ("first", "second", "third") else np.int64).ravel())
            at += 8 * n
        return cls(*arrays)

    def paths(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All n-grams with counts, as three columns of symbols, with zeros behind shorter ones."""
        own = np.flatnonzero(self.first_n)
        parent, arc = _expand(self.first_to, self.begin1, self.end1)
        h1, h2, n2 = self.first[parent], self.second[arc], self.second_n[arc]
        up, last = _expand(self.second_to[arc], self.begin2, self.end2)
        zero = lambda n: np.zeros(n, np.uint64)
        return (
            np.concatenate((self.first[own], h1, h1[up])),
            np.concatenate((zero(len(own)), h2, h2[up])),
            np.concatenate((zero(len(own) + len(h1)), self.third[last])),
            np.concatenate((self.first_n[own], n2, self.third_n[last])),
        )

    def compose(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Counts of the words (second is 0) or pairs of words; 0 for what has no path."""
        if not len(self.first):
            return np.zeros(len(first), np.int64)
        arc = np.minimum(np.searchsorted(self.first, first), len(self.first) - 1)
        there = self.first[arc] == first
        out = np.where(there & (second == 0), self.first_n[arc], 0)
        state = np.where(there & (second > 0), self.first_to[arc], -1)
        asked = np.flatnonzero(state >= 0)
        low, end = self.begin1[state[asked]], self.end1[state[asked]]
        high, want = end.copy(), second[asked]
        while (open_ := low < high).any():
            mid = (low + high) // 2
            less = open_ & (self.second[np.minimum(mid, len(self.second) - 1)] < want)
            low, high = np.where(less, mid + 1, low), np.where(open_ & ~less, mid, high)
        hit = (low < end) & (self.second[np.minimum(low, len(self.second) - 1)] == want)
        out[asked[hit]] = self.second_n[low[hit]]
        return out


def _expand(state: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every arc of every given state (-1: none): which one it was, and the arc."""
    which = np.flatnonzero(state >= 0)
    length = (end - begin)[state[which]] if len(which) else _ZERO
    stop = np.cumsum(length)
    arc = np.repeat(begin[state[which]] - (stop - length), length) + np.arange(length.sum()) if len(which) else _ZERO
    return np.repeat(which, length), arc


def _united(parts: list[Transducer], least: int) -> Transducer:
    """The sum of transducers, without n-grams of less weight than ``least``."""
    columns = [np.concatenate(c) for c in zip(*(p.paths() for p in parts), strict=True)]
    h, n = columns[:3], columns[3]
    with np.errstate(over="ignore"):
        key = mixed(h[0] * _MIX[0] + h[1] * _MIX[1] + h[2] * _MIX[2])
    order = np.argsort(key)
    new = np.concatenate(([True], key[order][1:] != key[order][:-1]))
    group = np.cumsum(new) - 1
    first = order[new]
    if not all((x[order] == x[first][group]).all() for x in h):  # a collision of keys: sort by the symbols
        order = np.lexsort(h[::-1])
        new = np.concatenate(([True], np.logical_or.reduce([x[order][1:] != x[order][:-1] for x in h])))
        first = order[new]
    total = np.add.reduceat(n[order], np.flatnonzero(new))
    kept = total >= least
    h, total = [x[first[kept]] for x in h], total[kept]
    order = np.lexsort(h[::-1])
    h, total = [x[order] for x in h], total[order]
    table = np.unique(np.concatenate(h))
    code = [np.searchsorted(table, x) for x in h]
    one, two, three = h[1] == 0, (h[1] > 0) & (h[2] == 0), h[2] > 0
    return Transducer.build(
        table, (code[0][one], total[one]), (code[0][two], code[1][two], total[two]),
        (code[0][three], code[1][three], code[2][three], total[three]),
    )


class _Block:
    """The words of a task by language, until they are counted."""

    def __init__(self) -> None:
        self.held: dict[str, tuple[_Vocabulary, array]] = {}

    def add(self, lang: str, words: list[bytes]) -> None:
        vocabulary, stream = self.held.get(lang) or self.held.setdefault(lang, (_Vocabulary(), array("i")))
        stream.extend(map(vocabulary.__getitem__, words))
        stream.append(-1)

    def shards(self) -> Iterator[tuple[str, Shard]]:
        for lang, (vocabulary, stream) in self.held.items():
            yield lang, shard(vocabulary, np.array(stream, np.int64))
        self.held = {}


def _counted(batches: Iterator[pa.RecordBatch], block_tokens: int) -> Iterator[tuple[str, Shard, int]]:
    """Language, shard and sign of each block of a task."""
    block, again, size = _Block(), _Block(), 0

    def out() -> Iterator[tuple[str, Shard, int]]:
        for part, sign in ((block, 1), (again, -1)):
            for lang, found in part.shards():
                yield lang, found, sign

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            for piece in _PIECES.split((text.as_py() or "").encode().lower()):
                words = piece.split()
                # A piece longer than a block is cut: the next part begins with the two words before the cut, and
                # what they hold by themselves, which is counted twice, is taken off.
                for i in range(0, len(words), block_tokens):
                    part = words[max(0, i - 2) : i + block_tokens]
                    if size and size + len(part) > block_tokens:
                        yield from out()
                        size = 0
                    block.add(lang, part)
                    size += len(part)
                    if i:
                        again.add(lang, words[i - 2 : i])
    yield from out()


_SHARD = "lang string, range int, tokens long, transducer binary, words binary"


def count_transducers(docs: DataFrame, splitters: list[int], block_tokens: int = 2_000_000) -> DataFrame:
    """lang, range, tokens, transducer and words (those of its single-word arcs) of every shard and range."""
    cuts = np.array(splitters, np.uint64)

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, s, sign in _counted(batches, block_tokens):
            v = np.int64(len(s.table))
            pair = s.three // v  # of the first two words
            ends = lambda x: [0, *np.searchsorted(x, cuts).tolist(), len(x)]
            a, b = ends(_place(s.table)), ends(_place(s.table[s.two // v], s.table[s.two % v]))
            c = ends(_place(s.table[pair // v], s.table[pair % v]))
            tokens = int(s.one.sum()) * sign
            rows = []
            for r in range(len(cuts) + 1):
                one, two, three = slice(a[r], a[r + 1]), slice(b[r], b[r + 1]), slice(c[r], c[r + 1])
                if a[r] == a[r + 1] and b[r] == b[r + 1]:
                    continue
                made = Transducer.build(
                    s.table,
                    (np.arange(a[r], a[r + 1]), s.one[one] * sign),
                    (s.two[two] // v, s.two[two] % v, s.two_n[two] * sign),
                    (pair[three] // v, pair[three] % v, s.three[three] % v, s.three_n[three] * sign),
                )
                rows.append((lang, r, tokens, made.pack(), b"\n".join(s.words[one])))
                tokens = 0
                if len(rows) == 64:
                    yield _rows(rows)
                    rows = []
            if rows:
                yield _rows(rows)

    columns = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")), "text")
    return columns.mapInArrow(tidy(built), _SHARD)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    lang, r, tokens, made, words = zip(*rows, strict=True)
    columns = [pa.array(lang, pa.string()), pa.array(r, pa.int32()), pa.array(tokens, pa.int64()), pa.array(made, pa.binary()), pa.array(words, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["lang", "range", "tokens", "transducer", "words"])


def united(shards: DataFrame, least: int) -> DataFrame:
    """lang, range, tokens, transducer and words: one row a language and range, pruned."""

    def added(group: pd.DataFrame) -> pd.DataFrame:
        parts = [Transducer.unpack(x) for x in group["transducer"]]
        whole = _united(parts, least)
        names: dict[int, bytes] = {}
        known = whole.first[whole.first_n > 0]
        for part, words in zip(parts, group["words"], strict=True):
            own = part.first[part.first_n != 0]
            at = np.minimum(np.searchsorted(known, own), max(0, len(known) - 1))
            some = np.flatnonzero(known[at] == own) if len(known) else ()
            listed = words.split(b"\n") if len(some) else []
            names |= {int(own[i]): listed[i] for i in some}
        return pd.DataFrame({
            "lang": group["lang"].iloc[:1],
            "range": group["range"].iloc[:1],
            "tokens": [int(group["tokens"].sum())],
            "transducer": [whole.pack()],
            "words": [b"\n".join(names[int(h)] for h in known)],
        })

    return shards.groupBy("lang", "range").applyInPandas(added, _SHARD)


def candidates(transducers: DataFrame) -> DataFrame:
    """lang, w1, w2, w3 (null for pairs), a and l2 (the count of the first two words of triples)."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                t = Transducer.unpack(data.as_py())
                h1, h2, h3, n = t.paths()
                kept = h2 > 0
                h1, h2, h3, n = h1[kept], h2[kept], h3[kept], n[kept]
                l2 = t.compose(h1, h2)
                for i in range(0, len(n), 20_000):
                    part = slice(i, i + 20_000)
                    short = h3[part] == 0
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(n[part]), pa.string()), *[pa.array(x[part].view(np.int64)) for x in (h1, h2)],
                         pa.array(h3[part].view(np.int64), mask=short), pa.array(n[part]), pa.array(l2[part], mask=short)],
                        ["lang", "w1", "w2", "w3", "a", "l2"],
                    )

    return transducers.select("lang", "transducer").mapInArrow(
        tidy(listed), "lang string, w1 long, w2 long, w3 long, a long, l2 long"
    )


def part_counts(rows: DataFrame, transducers: DataFrame, splitters: list[int], lookups: int = 100_000) -> DataFrame:
    """The candidates with l1 (first word), r1 (the rest after it) and r2 (last word of triples)."""
    cuts = np.array(splitters, np.uint64)
    part = lambda number, first, second: F.struct(F.lit(number).alias("part"), first.alias("first"), second.alias("second"))
    none = F.lit(0).cast("long")
    parts = F.array(
        part(1, F.col("w1"), none), part(2, F.col("w2"), F.coalesce("w3", none)), part(3, F.col("w3"), none),
    )
    asked = rows.select("lang", "w1", "w2", "w3", "a", "l2", F.explode(parts).alias("p")).where("p.first IS NOT NULL")

    @F.pandas_udf("int")
    def range_of(first: pd.Series, second: pd.Series) -> pd.Series:
        place = _place(first.to_numpy().view(np.uint64), second.to_numpy().view(np.uint64))
        return pd.Series(np.searchsorted(cuts, place, side="right").astype(np.int32))

    asked = asked.select("lang", "w1", "w2", "w3", "a", "l2", "p.part", "p.first", "p.second")
    asked = stored(asked.withColumn("range", range_of("first", "second")), "phrase-parts", compression="zstd")
    groups = asked.groupBy("lang", "range").agg(F.ceil(F.count("*") / lookups).cast("int").alias("groups"))
    asked = asked.join(groups, ["lang", "range"]).withColumn("salt", F.expr("cast(pmod(xxhash64(w1, w2, w3), groups) AS int)"))
    copies = transducers.select("lang", "range", "transducer").join(groups, ["lang", "range"])
    copies = copies.select("lang", "range", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("salt"), "transducer")

    def composed(left: pa.Table, right: pa.Table) -> pa.Table:
        n = np.zeros(left.num_rows, np.int64)
        if left.num_rows and right.num_rows:
            t = Transducer.unpack(right["transducer"][0].as_py())
            n = t.compose(*(left[c].to_numpy().view(np.uint64) for c in ("first", "second")))
        return left.select(["lang", "w1", "w2", "w3", "a", "l2", "part"]).append_column("n", pa.array(n))

    by = ["lang", "range", "salt"]
    answers = asked.drop("groups").groupBy(*by).cogroup(copies.groupBy(*by))
    answers = answers.applyInArrow(composed, "lang string, w1 long, w2 long, w3 long, a long, l2 long, part int, n long")
    of = lambda number, name: F.max(F.when(F.col("part") == number, F.col("n"))).alias(name)
    return answers.groupBy("lang", "w1", "w2", "w3", "a", "l2").agg(of(1, "l1"), of(2, "r1"), of(3, "r2"))


def splitters_of(docs: DataFrame, *, sample: int = 20_000, range_bytes: int = 8 << 20) -> list[int]:
    """Bounds of the ranges: quantiles of the distinct pairs of a sample of about so many documents."""
    rows = docs.count()
    every = max(1, rows // sample)
    some = docs.where(F.pmod(F.xxhash64("text"), F.lit(every)) == 0) if every > 1 else docs

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, s, _ in _counted(batches, 2_000_000):
            v = np.int64(len(s.table))
            # Triples by their first two words: as many rows as a shard has arcs there.
            pair = s.three // v
            place = _place(s.table[pair // v], s.table[pair % v])
            for i in range(0, len(place), 100_000):
                # Halved, so that it fits a signed number.
                yield pa.RecordBatch.from_arrays([pa.array((place[i : i + 100_000] >> np.uint64(1)).astype(np.int64))], ["place"])

    columns = some.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")), "text")
    places = stored(columns.mapInArrow(tidy(placed), "place long"), "phrase-places")
    arcs = places.count() * every
    ranges = max(8, -(-arcs * 24 // range_bytes))
    at = [i / ranges for i in range(1, ranges)]
    found = places.agg(F.percentile_approx("place", at, F.lit(10 * ranges + 10_000))).first()[0]
    return sorted({2 * x for x in found or []})


#: floor(1000000 a^2 / (l r)) in decimals of 38 digits.
SCORE = (
    "(cast(1000000 AS decimal(7,0)) * cast(a AS decimal(15,0)) * cast(a AS decimal(15,0)))"
    " div (cast({l} AS decimal(18,0)) * cast({r} AS decimal(18,0)))"
)


def phrases(
    docs: DataFrame, *, least: int = 10, share: int = 50, top: int = 2000, block_tokens: int = 2_000_000
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's first ``top`` phrases of two and three words."""
    splitters = splitters_of(docs)
    shards = count_transducers(docs, splitters, block_tokens)
    whole = stored(united(shards, least), "phrase-transducers", compression="zstd")
    counted = stored(part_counts(candidates(whole), whole, splitters), "phrase-candidates", compression="zstd")
    longer = counted.where("w3 IS NOT NULL")
    inside = longer.select("lang", "w1", "w2", "a").union(longer.select("lang", "w2", "w3", "a"))
    inside = inside.groupBy("lang", "w1", "w2").agg(F.max("a").alias("longest"))
    kept = counted.where("w3 IS NULL").join(inside, ["lang", "w1", "w2"], "left")
    kept = kept.where(F.expr("longest IS NULL OR 100 * longest < {0} * a".format(int(share)))).drop("longest").unionByName(longer)

    score = lambda left, right: F.expr(SCORE.format(l=left, r=right))
    cuts = kept.select("*", score("l1", "r1").alias("s1"), F.when(F.col("w3").isNotNull(), score("l2", "r2")).alias("s2"))
    second = F.col("s2") < F.col("s1")
    pick = lambda x, y: F.when(second, F.col(y)).otherwise(F.col(x))
    scored = cuts.select("lang", "w1", "w2", "w3", "a", pick("l1", "l2").alias("l"), pick("r1", "r2").alias("r"), pick("s1", "s2").alias("score"))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    leading = stored(scored.withColumn("place", F.rank().over(best)).where(F.col("place") <= top), "phrase-leading")

    names = whole.select("lang", "transducer", "words").mapInArrow(tidy(_named), "lang string, w long, name string")
    totals = whole.groupBy("lang").agg(F.sum("tokens").alias("n"))
    named = leading
    for i in (1, 2, 3):
        named = named.join(names.toDF("lang", f"w{i}", f"name{i}"), ["lang", f"w{i}"], "left")
    named = named.withColumn("phrase", F.concat_ws(" ", "name1", "name2", "name3")).join(totals, "lang")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    named = named.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return named.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of united transducers with their symbols."""
    for batch in batches:
        for lang, data, words in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
            t = Transducer.unpack(data.as_py())
            own = t.first[t.first_n > 0]
            names = words.as_py().decode().split("\n") if len(own) else []
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(own), pa.string()), pa.array(own.view(np.int64)), pa.array(names, pa.string())], ["lang", "w", "name"]
            )


def op12(docs: DataFrame) -> DataFrame:
    return phrases(docs)


#: DuckDB SQL for the query.
ORACLE_OP12 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), w AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
), totals AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang
), g AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) AS g
  FROM w, (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k
), f AS (
  SELECT lang, k, g, count(*) AS a FROM g GROUP BY lang, k, g
), c AS (
  SELECT lang, k, g, a, unnest(range(1, k)) AS cut FROM f WHERE k >= 2 AND a >= 10
), s AS (
  SELECT c.lang, c.k, c.g, c.a, c.cut, p.a AS l, q.a AS r,
    (1000000::HUGEINT * c.a * c.a) // (p.a::HUGEINT * q.a) AS score
  FROM c JOIN f p ON p.lang = c.lang AND p.g = c.g[1:c.cut] JOIN f q ON q.lang = c.lang AND q.g = c.g[c.cut + 1:]
), best AS (
  SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1
), inside AS (
  SELECT lang, g, max(a) AS longest FROM (
    SELECT lang, g[1:2] AS g, a FROM best WHERE k = 3 UNION ALL SELECT lang, g[2:3], a FROM best WHERE k = 3) GROUP BY lang, g
), kept AS (
  SELECT b.*, array_to_string(b.g, ' ') AS phrase FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.g = b.g
  WHERE b.k = 3 OR i.longest IS NULL OR 100 * i.longest < 50 * b.a
), ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
    CAST(score AS BIGINT) AS score FROM kept
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
