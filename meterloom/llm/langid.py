"""Language identification by compression.

Each language has a raw-content zstandard dictionary: slices of labelled training texts. A text is
lower-cased, runs of anything but letters become one space, and every block of ``block`` bytes of the
whole text is compressed with each dictionary; the language with the smallest sum wins. Where two
sums are within ``close`` bytes, a stronger level decides. ``score`` is the winner's share when a
difference of ``scale`` bytes counts as a factor e; ``confident`` is false when the margin to the
second is under ``margin`` of its size: such a prediction is rejected.

Fitting takes a bounded sample: at most ``sample`` texts a language, chosen by hash, one slice of
``slice_chars`` at a hashed place of each, up to ``dictionary_bytes`` a language and ``all_bytes`` for
all languages; this bounds what is collected and broadcast. Prediction covers every text whole.

Defined results: ``und`` with score 0 for a null text, one without letters, or if nothing was learned;
rows with a null lang or text teach nothing; ties go to the language with more training rows; repeated rows
give repeated results; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterloom.llm.common import remainder, stored

_OTHER = re.compile(r"[\W\d_]+")


def normalised(text: str) -> str:
    return _OTHER.sub(" ", text.lower()).strip()


def fit(
    labelled: DataFrame,
    *,
    sample: int = 400,
    slice_chars: int = 600,
    dictionary_bytes: int = 1 << 15,
    all_bytes: int = 8 << 20,
    languages: int = 256,
) -> dict[str, bytes]:
    """Dictionaries by language, the commonest first, from rows with text and lang.

    The ``languages`` labels with most distinct texts count as languages (ties: by name). Slices are cut to twice a
    dictionary's size before they reach the driver, so that at most 2 * ``all_bytes`` and a slice a language do.
    """
    rows = labelled.where("lang IS NOT NULL AND text IS NOT NULL AND length(text) > 0")
    key = F.xxhash64("text")
    rows = rows.select("lang", "text", key.alias("key"))
    # A row a language, stored, so that Spark sees its size and deals no text by language; the
    # thresholds leave about 3 * sample texts of each, however often one is copied.
    texts = rows.groupBy("lang", "key").agg(F.count("*").alias("n"))
    counts = stored(texts.groupBy("lang").agg(F.sum("n").alias("n"), F.count("*").alias("texts")), "language-counts")
    counts = counts.orderBy(F.desc("texts"), "lang").limit(languages)
    number = max(1, counts.count())
    most = min(dictionary_bytes, all_bytes // number)
    chance = (F.col("key").cast("double") / 2.0**64 + 0.5) * F.col("texts") <= 3 * sample
    room = F.greatest(F.length("text") - slice_chars, F.lit(0)) + 1
    cut = F.substring("text", (F.pmod(F.hash("key"), room) + 1).cast("int"), F.lit(slice_chars))
    few = rows.join(counts, "lang").where(chance).select("lang", "key", cut.alias("slice")).dropDuplicates(["lang", "key"])
    first = F.row_number().over(Window.partitionBy("lang").orderBy("key"))
    so_far = F.sum(F.octet_length("slice")).over(Window.partitionBy("lang").orderBy("key").rowsBetween(Window.unboundedPreceding, -1))
    few = few.withColumn("i", first).where(F.col("i") <= sample).withColumn("before", F.coalesce(so_far, F.lit(0)))
    few = few.where(F.col("before") <= 2 * most).orderBy("lang", "i")
    slices: dict[str, list[bytes]] = {}
    for lang, text in few.select("lang", "slice").toLocalIterator():
        slices.setdefault(lang, []).append(normalised(text).encode())
    seen = {lang: n for lang, n in counts.select("lang", "n").collect()}  # a row a language
    return {lang: b" ".join(slices[lang])[:most] for lang in sorted(slices, key=lambda x: (-seen[x], x))}


class Judge:
    """The compressors of one task."""

    def __init__(self, dictionaries: dict[str, bytes], block: int, close: int, scale: float) -> None:
        self.block, self.close, self.scale = block, close, scale
        self.quick = {lang: _compressor(d, 5) for lang, d in dictionaries.items()}
        self.strong = {lang: _compressor(d, 19) for lang, d in dictionaries.items()}

    def sizes(self, text: str, compressors: dict[str, zstandard.ZstdCompressor]) -> list[tuple[int, str]]:
        data = text.encode("utf-8", "replace")
        blocks = [data[i : i + self.block] for i in range(0, len(data), self.block)]
        sizes = [(sum(len(c.compress(b)) for b in blocks), lang) for lang, c in compressors.items()]
        return sorted(sizes, key=lambda x: x[0])  # stable

    def __call__(self, text: str | None) -> tuple[str, float, float]:
        """Language, score, relative margin."""
        text = normalised(text or "")
        if not self.quick or not any(map(str.isalpha, text)):
            return "und", 0.0, 0.0
        sizes = self.sizes(text, self.quick)
        if len(sizes) > 1 and sizes[1][0] - sizes[0][0] <= self.close:
            sizes = self.sizes(text, self.strong)
        least = sizes[0][0]
        score = 1 / sum(math.exp(max(-700.0, (least - size) / self.scale)) for size, _ in sizes)
        second = sizes[1][0] if len(sizes) > 1 else 2 * least
        return sizes[0][1], score, (second - least) / second


def _compressor(dictionary: bytes, level: int) -> zstandard.ZstdCompressor:
    d = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    d.precompute_compress(level=level)
    return zstandard.ZstdCompressor(
        level=level, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False
    )


def predict(
    docs: DataFrame, dictionaries: dict[str, bytes], *, block: int = 2048, close: int = 2, scale: float = 4.0, margin: float = 0.01
) -> DataFrame:
    """doc_id, lang_pred, score and confident of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)  # at most ``all_bytes``

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(shared.value, block, close, scale)
        for batch in batches:
            found = [judge(text.as_py()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                    pa.array([f[2] >= margin for f in found], pa.bool_()),
                ],
                ["doc_id", "lang_pred", "score", "confident"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(judged, f"doc_id {kind}, lang_pred string, score double, confident boolean")


def op5(docs: DataFrame) -> DataFrame:
    held_out = remainder(F.col("doc_id"), 5) == 0
    dictionaries = fit(docs.where(~held_out))
    return predict(docs, dictionaries).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "confident"
    )
