"""Small tables with every awkward case."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long, words string, node string, stats string, shard int"


def prose(seed: int, n: int, stems: str = "ka lo mi ren tu vas den or") -> str:
    draw = random.Random(seed)
    parts = stems.split()
    words = ["".join(draw.choices(parts, k=draw.randint(1, 3))) for _ in range(n)]
    return " ".join(w.capitalize() + "." if i % 11 == 10 else w for i, w in enumerate(words))


def documents(spark: SparkSession, texts: list[tuple[int | None, str | None]], lang: str | None = "en") -> DataFrame:
    rows = [(i, t, lang, "s1", len(t or ""), "x", "y", "z", 1) for i, t in texts]
    return spark.createDataFrame(rows, DOCS)


def awkward() -> list[tuple[int | None, str | None]]:
    """Nulls, empty and very long texts, ties, repeated rows and ids, a null id."""
    plain = prose(1, 60)
    return [
        (1, None), (2, ""), (3, " \t\n\r\x0b\x0c "), (4, plain), (5, plain), (5, plain), (6, plain.upper()), (None, plain),
        (None, None), (7, "a"), (8, "é" * 40), (9, "x" * 300_000), (10, prose(2, 20_000)), (11, "日本語 текст ½ ²"),
        (12, "line one two\n\nline one two\nline one two\r\n"), (13, "1" * 50_000), (14, "a@" * 20_000), (15, "+" * 20_000),
        (16, "<|endoftext|> İ Σ  \x85 \x1c"), (4, "other text of the same id, with seven words"),
    ]
