import random

from hypothesis import given, settings
from hypothesis import strategies as st

from orderloom.llm import language
from orderloom.llm.common import table


def phrases(sample, text):
    """Longest matches found by searching the sample."""
    count, at = 0, 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at : at + size + 1] in sample:
            size += 1
        if text[at] not in sample:
            size = 1
        count, at = count + 1, at + size
    return count


@settings(max_examples=200, deadline=None)
@given(st.text("abc ", max_size=40), st.text("abcd ", max_size=25))
def test_phrases_against_search(sample, text):
    assert language.SuffixAutomaton(sample).phrases(text) == phrases(sample, text)


def test_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = {r.doc_id: r for r in language.identify(docs).collect()}
    rows = docs.where("length(text) > 40").collect()
    held = [(r.lang, got[r.doc_id].lang_pred) for r in rows if got[r.doc_id].held_out]
    assert len(held) > 250 and sum(a == b for a, b in held) / len(held) > 0.98
    assert len(got) == 1000 and all(0 <= r.score <= 1 for r in got.values())


def test_held_out_languages_are_not_learned(spark, documents):
    from pyspark.sql import functions as F

    from orderloom.llm.common import held_out

    other = documents.withColumn("lang", F.when(held_out("doc_id", 3, 1), "xx").otherwise(F.col("lang")))
    a, b = (sorted(map(str, language.identify(d).collect())) for d in (documents, other))
    assert a == b


def test_brute_force_entropy(make):
    rng = random.Random(6)
    kinds = {"aa": "abcab", "bb": "bcddc"}
    rows = [
        (k, " ".join("".join(rng.choice(kinds[g]) for _ in range(5)) for _ in range(30)), g, "s")
        for k, g in enumerate(["aa", "bb"] * 30)
    ]
    df = make(rows)
    samples = language.learn_samples(
        df, id_col="doc_id", text_col="text", lang_col="lang", sample=500, seed=5
    )
    assert set(samples) == {"aa", "bb"} and all(len(s) <= 510 for s in samples.values())
    model = language.Model(samples)
    names, _ = model.predict([r[1] for r in rows])
    for (_, text, _, _), name in zip(rows, names, strict=True):
        cost = {
            g: sum(phrases(s, f" {w} ") for w in text.split()) * bits
            for (g, s), bits in zip(sorted(samples.items()), model.bits, strict=True)
        }
        assert name == min(cost, key=lambda g: (cost[g], g))


def test_odd_rows(make, odd_rows):
    got = language.identify(make(odd_rows)).collect()
    assert len(got) == len(odd_rows)
    by_id = {r.doc_id: r for r in got}
    assert all(by_id[k].lang_pred == "und" and by_id[k].score == 0 for k in (1, 2, 3, 12))
    assert by_id[13].lang_pred != "und" and by_id[11].lang_pred != "und"
    assert {r.lang_pred for r in got} <= {"und", "en", "fr", "de"}
    assert language.identify(make([])).collect() == []
    unlabelled = [(k, t, None, s) for k, t, _, s in odd_rows]
    assert {r.lang_pred for r in language.identify(make(unlabelled)).collect()} == {"und"}


def test_signs_are_no_letters():
    assert language.letters("²Ⅷ") == "" and language.letters("a²b") == "ab"


def test_rows_without_ids_teach(spark):
    """Hundreds of different texts without ids, and copies of one text, in two languages."""
    rng = random.Random(9)
    rows = []
    for lang, kinds in (("aa", "abcab"), ("bb", "bcddc")):
        texts = [" ".join("".join(rng.choice(kinds) for _ in range(6)) for _ in range(40)) for _ in range(300)]
        rows += [(None, t, lang) for t in texts + [texts[0]] * 500]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    samples = language.learn_samples(df, id_col="doc_id", text_col="text", lang_col="lang", sample=2_000, seed=5)
    assert {lang: len(s) > 1_500 for lang, s in samples.items()} == {"aa": True, "bb": True}
    # Copies of one text count once: the sample is not that text over and over.
    assert all(s.count(s[1:80]) == 1 for s in samples.values())
    got = language.identify(df).toPandas()
    assert sorted(got["lang_pred"].value_counts().items()) == [("aa", 800), ("bb", 800)]


def test_long_texts_give_a_stretch_from_anywhere(spark):
    """The start of every text is in one alphabet, the rest in another: the sample has the rest."""
    rows = [(k, "qqq " * 300 + f"w{'xyz'[k % 3]}v " * 5_000, "aa") for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    (sample,) = language.learn_samples(
        df, id_col="doc_id", text_col="text", lang_col="lang", sample=4_000, seed=5
    ).values()
    assert len(sample) > 3_900 and sample.count("v ") > 0.8 * sample.count(" ")
    assert {w for w in sample.split() if "w" in w} == {"wxv", "wyv", "wzv"}
