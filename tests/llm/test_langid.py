from pyspark.sql import functions as F

from meterloom.llm import langid
from tests.llm.cases import DOCS, awkward, documents, prose

STEMS = {"en": "the ing er on th and", "de": "sch ung keit ein ver zu", "fr": "eau ment que oi elle aux"}


def corpus(spark):
    rows, i = [], 0
    for lang, stems in STEMS.items():
        for seed in range(120):
            text = prose(seed, 30 + seed, stems)
            rows.append((i, text, lang, "s", len(text), "x", "y", "z", 1))
            i += 1
    return spark.createDataFrame(rows, DOCS)


def test_held_out_accuracy(spark):
    docs = corpus(spark)
    rows = langid.op5(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 40
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) >= 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_neither_language_nor_id_is_read_for_a_prediction(spark):
    docs = corpus(spark)
    dictionaries = langid.fit(docs)
    shuffled = docs.select((F.col("doc_id") * 7 + 1).alias("doc_id"), "text", F.lit("fr").alias("lang"))
    a = [r.lang_pred for r in langid.predict(docs, dictionaries).orderBy("doc_id").collect()]
    b = [r.lang_pred for r in langid.predict(shuffled, dictionaries).orderBy("doc_id").collect()]
    assert a == b


def test_awkward_texts(spark):
    dictionaries = langid.fit(corpus(spark))
    rows = langid.predict(documents(spark, awkward()), dictionaries).collect()
    assert len(rows) == len(awkward())
    by_id = {r.doc_id: r for r in rows}
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (1, 2, 3, 13, 15))
    assert by_id[10].lang_pred in STEMS
    assert langid.op5(documents(spark, awkward(), lang=None)).where("lang_pred <> 'und'").count() == 0
    assert langid.op5(corpus(spark).limit(0)).count() == 0


def test_narrow_margins_are_rejected(spark):
    dictionaries = langid.fit(corpus(spark))
    mixed = " ".join(prose(5, 40, STEMS["en"]).split() + prose(5, 40, STEMS["de"]).split())
    judge = langid.Judge({"en": dictionaries["en"], "xx": dictionaries["en"]}, 2048, 2, 4.0)
    assert judge(mixed)[2] == 0.0


def test_the_sample_is_bounded(spark):
    dictionaries = langid.fit(corpus(spark), sample=5, slice_chars=50, dictionary_bytes=200)
    assert set(dictionaries) == set(STEMS) and all(0 < len(d) <= 200 for d in dictionaries.values())


def test_copies_of_one_text_hide_no_language(spark):
    """60 texts of a language, one of them in 40,000 rows."""
    docs = corpus(spark)
    few = docs.where("lang = 'de' AND doc_id % 2 = 0")
    copies = docs.where("lang = 'de'").orderBy("doc_id").limit(1).crossJoin(spark.range(40_000).select(F.lit(0).alias("copy"))).drop("copy")
    dictionaries = langid.fit(docs.where("lang <> 'de'").union(few).union(copies), sample=30, dictionary_bytes=1 << 20)
    alone = langid.fit(few, sample=30, dictionary_bytes=1 << 20)
    assert set(dictionaries) == set(STEMS) and dictionaries["de"] == alone["de"]
    assert next(iter(dictionaries)) == "de"


def test_what_reaches_the_driver_is_bounded(spark):
    """Hundreds of dirty labels: the commonest count as languages, and together they stay below the bound."""
    texts = [(i, prose(i, 200), "en" if i % 2 else "de") for i in range(80)]
    texts += [(1000 + i, prose(1000 + i, 60), f"junk{i}") for i in range(150)]
    rows = spark.createDataFrame(texts, "doc_id long, text string, lang string").select("text", "lang")
    found = langid.fit(rows, all_bytes=4_000, languages=5)
    assert len(found) == 5 and {"de", "en"} <= set(found)
    assert sum(map(len, found.values())) <= 4_000
    assert set(langid.fit(rows, languages=2)) == {"de", "en"}
