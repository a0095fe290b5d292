"""Spelling variants: words one edit apart, by dense prefix-suffix tiling.

1. Words are counted where the texts are: a task counts the runs of letters of its batches, so a hot word is
   one row a flush, and counts are added by word.
2. Two words, the longer of ``m`` code points, are one insertion, deletion or replacement apart if and only if
   their lengths differ by one at most and common prefix + common suffix reach ``m - 1``. One of the two is
   then ``ceil((m - 1) / 2)`` long at least. So words meet in blocks of (m, side, that half), where a word of
   length L stands in the blocks of m = L and of m = L + 1, on both sides.
3. A block is cut into tiles of about ``tile`` words, and each pair of tiles is one unit of work; small blocks
   are one tile. Units are spread by hash and stream through a task sorted, one after another.
4. In a unit words are rows of padded code-point matrices, once from the left and once from the right, and all
   pairs of rows whose longer length is m are compared at once, in slices of bounded size: the common prefix
   and suffix are the runs of equal columns. A pair that shares both halves is reported by the prefix block.
   Only near pairs leave the task.
5. The form of a word is its near word of largest count; roots follow forms by pointer doubling, whose rounds
   are few, for counts grow by ``ratio`` at every step.

Defined results: a null text has no words; a null doc_id counts as empty text in the planted deletions; repeated
rows count each; words of any length are compared whole; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.llm.common import stored, tidy

_RUN = re.compile("[A-Za-z\u00c0-\u00ff]+")
_LOWER = {c: c + 32 for c in range(65, 91)}
_HELD = 400_000  # distinct words that a task holds before it gives counts out
_CELLS = 1 << 22  # of the comparison matrices at a time


def words_of(doc_id: object, text: str, divisor: int) -> Counter[str]:
    """Lower-cased runs of letters; one run in ``divisor``, by a checksum, loses a code point once."""
    runs = Counter(_RUN.findall(text.translate(_LOWER)))
    head = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    words: Counter[str] = Counter()  # apart from the runs: what a deletion leaves is not deleted from again
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), head)
        at = h % len(run) if h % divisor == 0 else len(run)
        words[run[:at] + run[at + 1 :]] += n
    return words


def word_counts(docs: DataFrame, *, divisor: int = 199, least_length: int = 6, least_count: int = 5) -> DataFrame:
    """word, n of all words of so many code points and occurrences."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for word, n in words_of(doc_id, text.as_py() or "", divisor).items():
                    if len(word) >= least_length:
                        held[word] += n
                if len(held) >= _HELD:
                    yield out()
                    held = Counter()
        if held:
            yield out()

    parts = docs.select(F.col("doc_id").cast("string"), "text").mapInArrow(tidy(counted), "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def near_pairs(words: DataFrame, tile: int = 1024) -> DataFrame:
    """x, y, n_x, n_y: every unordered pair of different words (word, n) one edit apart, once."""
    length = F.char_length("word")

    def half(m, side: str):
        """Of a word that meets others of length m at most."""
        p = F.ceil((m - 1) / 2).cast("int")
        part = F.substring("word", F.lit(1), p) if side == "p" else F.substring("word", -p, p)
        # A hash, so that keys of long words are short; words that meet by chance are told apart by comparison.
        return F.struct(m.alias("m"), F.lit(side == "p").alias("prefix"), F.xxhash64(part).alias("half"))

    keys = F.array(*[half(m, side) for m in (length, length + 1) for side in "ps"])
    members = words.select("word", "n", length.alias("length"), F.explode(keys).alias("block"))
    members = members.select("word", "n", "block.*", (F.col("length") == F.col("block.m")).alias("long"))
    crowd = members.groupBy("m", "prefix", "half").agg(F.count("*").alias("crowd"), F.max("long").alias("any"))
    # Without a word of length m nothing is compared.
    crowd = crowd.where("crowd > 1 AND any").withColumn("tiles", F.ceil(F.col("crowd") / tile).cast("int"))
    placed = members.join(crowd.drop("any", "crowd"), ["m", "prefix", "half"])
    own = F.expr("cast(pmod(xxhash64(word, 7), tiles) AS int)")
    placed = placed.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    unit = ["m", "prefix", "half", "low", "high"]
    placed = placed.withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))
    placed = placed.select(*unit, (F.col("own") == F.col("low")).alias("lower"), "long", "word", "n")
    units = placed.repartition(*unit).sortWithinPartitions(*unit)

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, lower, words_, counts = None, [], [], []
        found: list[tuple[str, str, int, int]] = []
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for m, prefix, h, lo, hi, low, _, word, n in zip(*columns, strict=True):
                if (m, prefix, h, lo, hi) != key:
                    if key:
                        found += _near(words_, counts, lower, key)
                    key, lower, words_, counts = (m, prefix, h, lo, hi), [], [], []
                lower.append(low)
                words_.append(word)
                counts.append(n)
            if len(found) >= 10_000:
                yield _pairs_batch(found)
                found = []
        if key:
            found += _near(words_, counts, lower, key)
        if found:
            yield _pairs_batch(found)

    return units.mapInArrow(tidy(compared), "x string, y string, n_x long, n_y long")


def _pairs_batch(rows: list[tuple[str, str, int, int]]) -> pa.RecordBatch:
    x, y, n_x, n_y = zip(*rows, strict=True)
    columns = [pa.array(x, pa.string()), pa.array(y, pa.string()), pa.array(n_x, pa.int64()), pa.array(n_y, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["x", "y", "n_x", "n_y"])


def _matrix(words: list[str], width: int, right: bool) -> np.ndarray:
    """Code points of the words, a row each, padded with zeros on the right, or on the left."""
    padded = "".join(w.rjust(width, "\0") if right else w.ljust(width, "\0") for w in words)
    return np.frombuffer(padded.encode("utf-32-le"), "<u4").astype(np.uint16).reshape(len(words), width)


def _run_length(same: np.ndarray) -> np.ndarray:
    """Of the leading run of true values along the last axis."""
    return np.where(same.all(-1), same.shape[-1], (~same).argmax(-1))


def _near(words: list[str], counts: list[int], lower: list[bool], key: tuple) -> Iterator[tuple[str, str, int, int]]:
    """The near pairs of one unit: of one tile among themselves, or across two."""
    m, prefix, _, lo, hi = key
    at = np.arange(len(words))
    low = np.array(lower)
    rows, columns = (at, at) if lo == hi else (at[low], at[~low])
    if not len(rows) or not len(columns) or len(words) < 2:
        return
    half = -(-(m - 1) // 2)
    length = np.array([len(w) for w in words])
    left, right = _matrix(words, m, False), _matrix(words, m, True)
    step = max(1, _CELLS // m)
    # Slices of rows by slices of columns; at least one by one.
    wide = min(len(columns), step)
    tall = max(1, step // wide)
    for i in range(0, len(rows), tall):
        r = rows[i : i + tall]
        for j in range(0, len(columns), wide):
            c = columns[j : j + wide]
            shorter = np.minimum(length[r][:, None], length[c][None, :])
            pre = np.minimum(_run_length(left[r][:, None, :] == left[c][None, :, :]), shorter)
            longest = np.maximum(length[r][:, None], length[c][None, :]) == m
            if lo == hi:
                longest &= r[:, None] < c[None, :]
            longest &= (pre >= half) if prefix else (pre < half)
            a, b = np.nonzero(longest)
            if not len(a):
                continue
            suf = np.minimum(_run_length((right[r[a]] == right[c[b]])[:, ::-1]), shorter[a, b])
            near = pre[a, b] + suf >= m - 1
            for x, y in zip(r[a[near]].tolist(), c[b[near]].tolist(), strict=True):
                yield words[x], words[y], counts[x], counts[y]


def spelling_forms(words: DataFrame, *, ratio: int = 5, tile: int = 1024) -> DataFrame:
    """word, n, n_near, form, form_n and root of every word (word, n)."""
    pairs = stored(near_pairs(words, tile), "near-words")
    sides = pairs.select(F.col("x").alias("word"), F.col("y").alias("near"), F.col("n_y").alias("near_n"))
    sides = sides.union(pairs.select("y", "x", "n_x"))
    best = sides.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("o"), "near")).alias("best"))
    joined = words.join(best, "word", "left")
    large = -F.col("best.o") >= ratio * F.col("n")
    forms = joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(large, F.col("best.near")).alias("form"), F.when(large, -F.col("best.o")).alias("form_n"),
    )
    forms = stored(forms, "forms")
    links = stored(forms.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        links = links.join(further, "root", "left")
        links = links.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        links = stored(links, "roots")
        moved, links = links.where("moved"), links.drop("moved")
        if moved.isEmpty():
            break
    out = forms.join(links, "word", "left")
    return out.select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def op13(docs: DataFrame) -> DataFrame:
    words = stored(word_counts(docs), "words")
    return spelling_forms(words).select("word", "form", "root", "n", "n_near", "form_n")


#: DuckDB SQL for the query: checksums byte by byte from a table of remainders, near words by what is left of
#: them without one code point.
ORACLE_OP13 = r"""
WITH RECURSIVE bits(i, c, k) AS (
  SELECT range, range, 0 FROM range(256)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
), remainders AS (
  SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8
), runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents
), counted AS (
  SELECT doc_id, run, count(*) AS n FROM runs GROUP BY doc_id, run
), hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
      range(0, CAST(octet_length(encode(concat(doc_id, ':', run))) AS BIGINT)),
      lambda i: CAST(('0x' || substr(hex(encode(concat(doc_id, ':', run))), CAST(2 * i + 1 AS BIGINT), 2)) AS BIGINT))),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM counted, remainders
), planted AS (
  SELECT CASE WHEN h % 199 = 0 THEN concat(substr(run, 1, h % length(run)), substr(run, h % length(run) + 2)) ELSE run END AS word, n
  FROM hashed
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM planted WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), holes AS (
  SELECT DISTINCT word, n, left(word, i - 1) || substr(word, i + 1) AS hole, i
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  -- One code point replaced: the same hole at the same place.
  SELECT a.word, b.word AS near, b.n AS near_n FROM holes a JOIN holes b ON a.hole = b.hole AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM holes a JOIN words b ON a.hole = b.word
  UNION SELECT b.word, a.word, a.n FROM holes a JOIN words b ON a.hole = b.word
), best AS (
  SELECT word, count(*) AS n_near, arg_min(near, (-near_n, near)) AS near, max(near_n) AS near_n FROM near GROUP BY word
), forms AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.near_n >= 5 * w.n THEN b.near END AS form,
    CASE WHEN b.near_n >= 5 * w.n THEN b.near_n END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word
), walk(word, root) AS (
  SELECT word, word FROM forms
  UNION ALL
  SELECT k.word, f.form FROM walk k JOIN forms f ON f.word = k.root WHERE f.form IS NOT NULL
), roots AS (
  SELECT k.word, k.root FROM walk k JOIN forms f ON f.word = k.root WHERE f.form IS NULL
)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n FROM forms f JOIN roots r ON r.word = f.word
"""
