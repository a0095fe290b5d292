"""Quality rules: base statistics, then robust multivariate outliers by language and source.

Base statistics come from array functions over the words of the whole text; windows of five words are
compared by 64-bit hashes, and sorting them with their places costs n log n for any text.

The vector of a text is ``VECTOR``: logarithms and rates a word. For each (language, source) the
minimum-covariance-determinant estimate looks for the ``core`` share of rows whose covariance has the smallest
determinant. Three deterministic starts, rows of one table, take concentration steps side by side: the mean and
covariance of all rows; medians and quartile ranges; and the correlations of tanh-transformed parts with those ranges. A step keeps
the rows within the core quantile of squared Mahalanobis distance and takes their mean and covariance anew; it never raises
the determinant. Steps end when no group's limit moves by a hundredth, or after ``steps``. Of a group's starts the one with
the smallest determinant stays. Each step is two aggregations that combine before they shuffle, so a hot source is one
row a task.

Each variance gets a floor (most clean texts have no symbols at all), and a group's estimate is weighed against its language's
as ``prior`` rows, which serves small groups without a switch. In the end a covariance is multiplied by limit / 7.84, so that the core quantile
of squared distances is that of the chi-square law of six parts, as for a normal law; where the floors are
wider than the data, so that the limit is less already, it stays. A text is rejected when its squared distance, times n / (n + ``short``)
for n words (rates of short texts scatter more), is beyond ``cut``.

Defined results: a null or empty text has no words and fails the base rule; a null language or source
is a group like any other; repeated rows count each; an empty table gives no rows; other columns, of
any name, pass through ``passed`` untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterloom.llm.common import SPACE, every, let, sent, stored

WINDOW = 5
#: Names of the vector's parts, each with its variance floor.
VECTOR = {"log_length": 0.06**2, "log_symbols": 0.08**2, "log_marks": 0.08**2, "capitals": 0.04**2, "repeats": 0.05**2, "dup_lines": 0.05**2}
_SIZE = len(VECTOR)
_PAIRS = [(i, j) for i in range(_SIZE) for j in range(i + 1)]


def _repeat_words(words: Column) -> Column:
    """Words in windows of five that occur twice or more."""

    def covered(places: Column) -> Column:
        width = F.transform(
            places,
            lambda at, k: F.when(k + 1 < F.size(places), F.least(F.lit(WINDOW), F.get(places, k + 1) - at)).otherwise(WINDOW),
        )
        return F.aggregate(width, F.lit(0).cast("long"), lambda a, b: a + b)

    def again(pairs: Column) -> Column:
        # At either end one neighbour is missing, and a null is no match.
        alike = lambda e, k: F.coalesce(F.get(pairs, k)["h"] == e["h"], F.lit(False))
        kept = F.filter(pairs, lambda e, k: alike(e, k - 1) | alike(e, k + 1))
        return let(F.sort_array(F.transform(kept, lambda e: e["at"])), covered)

    def counted(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, at: F.struct(h.alias("h"), at.alias("at"))))
        some = F.size(F.array_distinct(hashes)) < F.size(hashes)
        return F.when(some, let(pairs, again)).otherwise(F.lit(0).cast("long"))

    def windows(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - WINDOW)
        hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]))
        return F.when(F.size(w) >= WINDOW, let(hashes, counted)).otherwise(F.lit(0).cast("long"))

    return windows(words)


def statistics(text: Column) -> Column:
    """A struct of the base statistics and the counts that the vector needs."""
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))

    def with_words(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            _repeat_words(words).alias("n_repeat_words"),
        )

    def joined(w: Column) -> Column:
        return F.struct(
            w["n_words"].alias("n_words"),
            w["word_chars"].alias("word_chars"),
            F.regexp_count(whole, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
            let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
            w["n_repeat_words"].alias("n_repeat_words"),
            F.regexp_count(whole, F.lit("[!?]")).cast("long").alias("n_marks"),
            F.regexp_count(whole, F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
            let(lines, lambda x: F.size(x).cast("long")).alias("n_lines"),
        )

    words = F.filter(F.split(whole, SPACE), lambda x: x != "")
    return let(let(words, with_words), joined)


def base_failed(s: Column) -> Column:
    return (s["n_words"] < 10) | (100 * s["n_repeat_words"] > 20 * s["n_words"])


def vector(s: Column) -> list[Column]:
    """The transformed statistics, in the order of ``VECTOR``."""
    words = F.greatest(s["n_words"], F.lit(1)).cast("double")
    rate = lambda name: s[name] / words
    return [
        F.log(1 + rate("word_chars")),
        F.log(1 + 5 * rate("n_symbols")),
        F.log(1 + 5 * rate("n_marks")),
        s["n_capitals"] / F.greatest(s["word_chars"], F.lit(1)).cast("double"),
        rate("n_repeat_words"),
        s["n_dup_lines"] / F.greatest(s["n_lines"], F.lit(1)).cast("double"),
    ]


def _group(lang: Column, source: Column) -> Column:
    """One text for a pair, nulls included."""
    mark = lambda c: F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-"))
    return F.concat(mark(lang), F.lit("\n"), mark(source))


def _distance(rows: DataFrame) -> DataFrame:
    """Adds d2: forward substitution with the group's Cholesky factor l_i_j around its centre m_i."""
    for i in range(_SIZE):
        inner = sum((F.col(f"l_{i}_{j}") * F.col(f"y_{j}") for j in range(i)), F.lit(0.0))
        rows = rows.withColumn(f"y_{i}", (F.col(f"x_{i}") - F.col(f"m_{i}") - inner) / F.col(f"l_{i}_{i}"))
    return rows.withColumn("d2", sum((F.col(f"y_{i}") ** 2 for i in range(_SIZE)), F.lit(0.0)))


def _cholesky(groups: DataFrame) -> DataFrame:
    """Factors of the covariances c_i_j; floors keep every pivot positive."""
    floors = list(VECTOR.values())
    for i, j in _PAIRS:
        inner = sum((F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}") for k in range(j)), F.lit(0.0))
        left = F.col(f"c_{i}_{j}") + (floors[i] if i == j else 0.0) - inner
        pivot = F.sqrt(F.greatest(left, F.lit(floors[i])))
        groups = groups.withColumn(f"l_{i}_{j}", pivot if i == j else left / F.col(f"l_{j}_{j}"))
    return groups


def _pooled(groups: DataFrame, prior: float) -> DataFrame:
    """Moments of groups and starts (n, mean, covariance), each weighed against its language's."""
    xs = range(_SIZE)
    lang = groups.groupBy("lang_key", "start").agg(
        F.sum("n").alias("n_l"),
        *[(F.sum(F.col("n") * F.col(f"m_{i}")) / F.sum("n")).alias(f"p_{i}") for i in xs],
        *[
            (F.sum(F.col("n") * (F.col(f"c_{i}_{j}") + F.col(f"m_{i}") * F.col(f"m_{j}"))) / F.sum("n")).alias(f"q_{i}_{j}")
            for i, j in _PAIRS
        ],
    )
    both = groups.join(lang, ["lang_key", "start"])
    w = F.col("n") / (F.col("n") + prior)
    mean = [w * F.col(f"m_{i}") + (1 - w) * F.col(f"p_{i}") for i in xs]
    gap = [F.col(f"m_{i}") - F.col(f"p_{i}") for i in xs]
    cov = [
        w * F.col(f"c_{i}_{j}") + (1 - w) * (F.col(f"q_{i}_{j}") - F.col(f"p_{i}") * F.col(f"p_{j}")) + w * (1 - w) * gap[i] * gap[j]
        for i, j in _PAIRS
    ]
    return both.select(
        "group", "start", "lang_key", *[m.alias(f"m_{i}") for i, m in enumerate(mean)],
        *[c.alias(f"c_{i}_{j}") for (i, j), c in zip(_PAIRS, cov, strict=True)],
    )


def _moments(by: list[str]) -> list[Column]:
    xs = range(_SIZE)
    return [
        F.count("*").alias("n"),
        *[F.avg(f"{by[0]}_{i}").alias(f"m_{i}") for i in xs],
        *[F.covar_pop(f"{by[0]}_{i}", f"{by[0]}_{j}").alias(f"c_{i}_{j}") for i, j in _PAIRS],
    ]


def starts(vectors: DataFrame, accuracy: int) -> DataFrame:
    """group, lang_key, start, m_i and c_i_j: three deterministic beginnings of each group."""
    xs = range(_SIZE)
    quarters = vectors.groupBy("group", "lang_key").agg(
        *[F.percentile_approx(f"x_{i}", [0.25, 0.5, 0.75], accuracy).alias(f"t_{i}") for i in xs]
    )
    floors = [v**0.5 for v in VECTOR.values()]
    # The range between quartiles of a normal law is 1.349 deviations.
    middle = quarters.select(
        "group", "lang_key", *[F.col(f"t_{i}")[1].alias(f"mid_{i}") for i in xs],
        *[F.greatest((F.col(f"t_{i}")[2] - F.col(f"t_{i}")[0]) / 1.349, F.lit(floors[i])).alias(f"dev_{i}") for i in xs],
    )
    middle = stored(middle, "mcd-middle")
    names = ["group", "lang_key", *[f"m_{i}" for i in xs], *[f"c_{i}_{j}" for i, j in _PAIRS]]
    plain = vectors.groupBy("group", "lang_key").agg(*_moments(["x"])).select(*names, F.lit(0).alias("start"))
    apart = middle.select(
        "group", "lang_key", *[F.col(f"mid_{i}").alias(f"m_{i}") for i in xs],
        *[(F.col(f"dev_{i}") ** 2 if i == j else F.lit(0.0)).alias(f"c_{i}_{j}") for i, j in _PAIRS], F.lit(1).alias("start"),
    )
    bent = vectors.join(sent(middle.drop("lang_key"), FEW), "group").select(
        "group", "lang_key", *[F.tanh((F.col(f"x_{i}") - F.col(f"mid_{i}")) / F.col(f"dev_{i}")).alias(f"z_{i}") for i in xs]
    )
    bent = bent.groupBy("group", "lang_key").agg(*_moments(["z"])).join(middle.drop("lang_key"), "group")
    tiny = F.lit(1e-6)
    scale = lambda i: F.col(f"dev_{i}") / F.sqrt(F.greatest(F.col(f"c_{i}_{i}"), tiny))
    bent = bent.select(
        "group", "lang_key", *[F.col(f"mid_{i}").alias(f"m_{i}") for i in xs],
        *[(F.col(f"dev_{i}") ** 2 if i == j else F.col(f"c_{i}_{j}") * scale(i) * scale(j)).alias(f"c_{i}_{j}") for i, j in _PAIRS],
        F.lit(2).alias("start"),
    )
    return plain.unionByName(apart).unionByName(bent)


#: Estimates of up to so many groups and starts, about 16 MB, go to every task, so that no text is dealt by group.
FEW = 50_000
#: The chi-square quantile at 0.75 of as many degrees of freedom as the vector has parts.
CHI_SQUARE = 7.84080


def estimate(vectors: DataFrame, *, steps: int = 5, core: float = 0.75, prior: float = 50.0, accuracy: int = 1000) -> DataFrame:
    """Centre and Cholesky factor of each group, from rows of group, lang_key and x_0, x_1, ...; with its start and log_det."""
    kept = ["group", "start", *[f"m_{i}" for i in range(_SIZE)], *[f"l_{i}_{j}" for i, j in _PAIRS]]
    spread = stored  # a row a group and start
    found = spread(_cholesky(starts(vectors, accuracy)).select(*kept), "mcd-start")
    before = None
    for step in range(steps + 1):
        rows = _distance(vectors.join(sent(found, FEW), "group")).select("group", "start", "lang_key", "d2", *[f"x_{i}" for i in range(_SIZE)])
        limits = spread(rows.groupBy("group", "start").agg(F.percentile_approx("d2", core, accuracy).alias("limit")), "mcd-limits")
        if before is not None:
            moved = limits.join(before.withColumnRenamed("limit", "old"), ["group", "start"])
            if step == steps or moved.where(F.abs(F.col("limit") - F.col("old")) > 0.01 * F.col("old") + 1e-9).isEmpty():
                break
        near = rows.join(sent(limits, FEW), ["group", "start"]).where("d2 <= limit")
        moments = spread(near.groupBy("group", "start", "lang_key").agg(*_moments(["x"])), "mcd-moments")
        found, before = spread(_cholesky(_pooled(moments, prior)).select(*kept), "mcd"), limits
    log_det = 2 * sum((F.log(F.col(f"l_{i}_{i}")) for i in range(_SIZE)), F.lit(0.0))
    whole = found.join(limits, ["group", "start"]).withColumn("log_det", log_det)
    # Determinants that are alike tell nothing: the first start of them stays.
    order = F.struct(F.round("log_det", 3), "start")
    best = whole.groupBy("group").agg(F.min_by(F.struct(*kept[1:], "limit", "log_det"), order).alias("best")).select("group", "best.*")
    wider = F.sqrt(F.greatest(F.col("limit") / CHI_SQUARE, F.lit(1.0)))
    return spread(
        best.select(
            "group", "start", "log_det", *[f"m_{i}" for i in range(_SIZE)],
            *[(F.col(f"l_{i}_{j}") * wider).alias(f"l_{i}_{j}") for i, j in _PAIRS],
        ),
        "mcd-best",
    )


def _verdict(rows: DataFrame, stats: Column, cut: float, short: float) -> DataFrame:
    n = stats["n_words"].cast("double")
    far = F.col("d2") * n / (n + short) > cut
    return rows.withColumn("rejected", base_failed(stats) | F.coalesce(far, F.lit(False)))


def _measured(docs: DataFrame, keep: list[str]) -> DataFrame:
    return docs.select(
        F.struct(*every(keep)).alias("doc"),
        statistics(F.col("text")).alias("stats"),
        _group(F.col("lang"), F.col("source")).alias("group"),
        F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("-")).alias("lang_key"),
    )


def _against(rows: DataFrame, known: DataFrame, *, cut: float = 60.0, short: float = 40.0, **options: float) -> DataFrame:
    """``rows`` judged by the estimate over ``known``, their stored measures."""
    parts = [v.alias(f"x_{i}") for i, v in enumerate(vector(F.col("stats")))]
    # Texts that fail the base rule are no pattern of a good one.
    good = known.where(~base_failed(F.col("stats"))).select("group", "lang_key", *parts)
    found = estimate(good, **options)
    # A group without a good text has no estimate; all its rows fail the base rule.
    both = rows.select("doc", "stats", "group", *parts).join(sent(found, FEW), "group", "left")
    return _verdict(_distance(both), F.col("stats"), cut, short).select("doc", "stats", "d2", "rejected")


def judged(docs: DataFrame, *, keep: list[str], **options: float) -> DataFrame:
    """Columns ``keep`` in a struct ``doc``, stats, d2 (robust squared distance) and rejected."""
    rows = stored(_measured(docs, keep), "quality-rows")
    return _against(rows, rows, **options)


def passed(docs: DataFrame, **options: float) -> DataFrame:
    """The documents that are not rejected, with all their columns.

    Only the measures are stored, not the documents a second time; they are taken again as the documents are judged.
    """
    rows = _measured(docs, docs.columns)
    known = stored(rows.drop("doc"), "quality-rows")
    # In one piece: a condition that Spark takes apart is tried before the join, which measures the text for each part anew.
    kept = F.coalesce(~F.col("rejected"), F.lit(False)) == F.lit(True)
    return _against(rows, known, **options).where(kept).select("doc.*")


def op3(docs: DataFrame) -> DataFrame:
    rows = judged(docs, keep=["doc_id"])
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return rows.select(
        "doc.doc_id",
        *[F.col(f"stats.{name}").alias(name) for name in base],
        base_failed(F.col("stats")).alias("base_failed"),
        (~F.col("rejected")).alias("kept"),
        "d2",
    )
