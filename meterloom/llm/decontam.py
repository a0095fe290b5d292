"""Benchmark decontamination by spaced-seed hashing.

Texts are lower-cased and cut at everything but letters and digits. A mask reads the words at its ones
and ignores those at its zeros, so that a substituted word under a zero leaves the seed intact. Seeds
of the items are joined with those of every window of every document; each hit names a document, an
item and the shift between them. Around each distinct shift the aligned words are compared: a pair
counts when some window of ``window`` item words (all of a shorter item) has ``share`` of its words, and
``least`` at any rate, equal at the same places.

Short items leave little room between substituted words, so items of up to ``SHORT`` words have seeds of lighter
masks as well. Over all placements of the substitutions that ``share`` allows, items of 8 to 14 words and of 16 to 19 always share a
seed with their match, those of 15 words in 0.985 of the placements and windows of 20 in 0.999 (enumerated in the tests).
Items of fewer than ``least`` words match whole: five words or more wherever they stand in a document, fewer only a
document that consists of them.

The items are the stated query set. Their seeds are broadcast in blocks of at most ``block`` rows, so
the broadcast has a bound at every size of the benchmark; documents are exploded inside one stage and
only hits are shuffled, combined beforehand by document, item and shift.

Output, a row a pair: doc_id, item_id, shift, matched, compared, similarity.

Rows are told apart by doc_id and a 128-bit hash of the text; only the report folds them by doc_id.

Defined results: null and empty texts, and items without words, match nothing; repeated rows
of one doc_id, or of one item_id, give one row a pair, the best (ties: the smallest shift); rows of one
id with different texts, or without an id, are compared, kept and removed each by its own text; an empty
table gives no rows; null ids are ids like any other; only the named columns are read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterloom.llm.common import stored, text_key

MASKS = ("111111", "1110111", "11011011")
#: For items of up to SHORT words only.
LIGHT_MASKS = ("11111", "1101011", "1111001")
SHORT = 14
_SHORTEST = min(len(m) for m in LIGHT_MASKS)
_WHOLE = -1  # the mask of a text shorter than all masks


def word_hashes(text: Column) -> Column:
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def _seeds(table: DataFrame, *, items: bool) -> DataFrame:
    """Every seed of ``words``: adds at (place of its first word) and seed; a mask that runs over the end reads less."""
    n = F.size("words")
    # Texts shorter than every mask are one seed.
    places = F.when(n >= _SHORTEST, F.sequence(F.lit(0), n - _SHORTEST)).otherwise(F.array(F.lit(0)))
    table = table.where(n > 0).withColumn("at", F.explode(places))
    read = lambda mask: [F.get("words", F.col("at") + k) for k, bit in enumerate(mask) if bit == "1"]
    keys = [F.xxhash64(F.lit(i), *read(mask)) for i, mask in enumerate(MASKS + LIGHT_MASKS)]
    whole = F.array(F.xxhash64(F.lit(_WHOLE), "words"))
    every, heavy = F.array(*keys), F.array(*keys[: len(MASKS)])
    long = F.when(n <= SHORT, every).otherwise(heavy) if items else every
    return table.withColumn("seed", F.explode(F.when(n < _SHORTEST, whole).otherwise(long)))


def _best(same: Column, width: Column) -> Column:
    """The most ones in ``width`` places that follow each other."""
    starts = F.sequence(F.lit(1), F.size(same) - width + 1)
    ones = lambda at: F.aggregate(F.slice(same, at, width), F.lit(0), lambda a, x: a + x)
    return F.array_max(F.transform(starts, ones))


def _matches(
    docs: DataFrame, benchmark: DataFrame, *, window: int = 20, share: float = 0.8, least: int = 8, block: int = 500_000
) -> DataFrame:
    """doc_id, text_key, item_id, shift, matched and compared of every shift that counts."""
    items = benchmark.select("item_id", word_hashes(F.col("text")).alias("words")).where(F.size("words") > 0)
    items = stored(items.withColumn("item", F.xxhash64("item_id", "words")).dropDuplicates(["item"]), "items")
    seeds = stored(_seeds(items, items=True).select("seed", "item", F.col("at").alias("item_at"), F.size("words").alias("item_words")), "seeds")
    blocks = max(1, -(-seeds.count() // block))
    texts = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), word_hashes(F.col("text")).alias("words"))
    every = _seeds(texts, items=False)
    hits = []
    for i in range(blocks):
        some = seeds if blocks == 1 else seeds.where(F.pmod(F.xxhash64("seed"), F.lit(blocks)) == i)
        hit = every.join(F.broadcast(some), "seed").withColumn("shift", F.col("at") - F.col("item_at"))
        first = F.greatest(F.col("shift"), F.lit(0))
        stop = F.least(F.col("shift") + F.col("item_words"), F.size("words"))
        hits.append(
            hit.select("doc_id", "text_key", "item", "shift", F.slice("words", first + 1, stop - first).alias("there"))
            .groupBy("doc_id", "text_key", "item", "shift")
            .agg(F.first("there").alias("there"))
        )
    found = reduce(DataFrame.unionAll, hits).join(items, "item")
    first = F.greatest(-F.col("shift"), F.lit(0))
    own = F.slice("words", first + 1, F.size("there"))
    same = F.zip_with(own, "there", lambda a, b: (a == b).cast("int"))
    width = F.least(F.lit(window), F.size("words"))
    all_ = F.least(F.lit(least), F.size("words"))  # of an item shorter than that
    found = found.select("doc_id", "text_key", "item_id", "shift", same.alias("same"), width.alias("compared"), all_.alias("all"))
    found = found.where(F.size("same") >= F.col("all"))
    matched = F.when(F.size("same") >= F.col("compared"), _best(F.col("same"), F.col("compared"))).otherwise(
        F.aggregate("same", F.lit(0), lambda a, x: a + x)
    )
    found = found.withColumn("matched", matched)
    enough = F.greatest(F.ceil(F.col("compared") * share - 1e-9), F.col("all"))
    return found.where(F.col("matched") >= enough)


def contaminated(docs: DataFrame, benchmark: DataFrame, **options: float) -> DataFrame:
    found = _matches(docs, benchmark, **options)
    best = F.max(F.struct("matched", (-F.col("shift")).alias("back"), "compared"))
    return found.groupBy("doc_id", "item_id").agg(best.alias("best")).select(
        "doc_id",
        "item_id",
        (-F.col("best.back")).alias("shift"),
        F.col("best.matched").alias("matched"),
        F.col("best.compared").alias("compared"),
        (F.col("best.matched") / F.col("best.compared")).alias("similarity"),
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, **options: float) -> DataFrame:
    """The documents that match no item, with all their columns."""
    gone = _matches(docs, benchmark, **options).select(F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_text"))
    gone = stored(gone.distinct(), "contaminated")
    same = docs["doc_id"].eqNullSafe(gone["gone_id"]) & (text_key(docs["text"]) == gone["gone_text"])
    return docs.join(gone, same, "left_anti")


def op10(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return contaminated(docs, benchmark)
