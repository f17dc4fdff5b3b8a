import random

import numpy as np

from orderloom.llm import quality
from orderloom.llm.common import table


def test_held_out_accuracy(spark, labels):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = {r.doc_id: r for r in quality.classify(docs, labels).collect()}
    assert len(got) == 1000
    held = [(r.quality, got[r.doc_id]) for r in labels.collect() if got[r.doc_id].held_out]
    right = sum(q == r.predicted for q, r in held)
    assert right / len(held) > 0.97
    bad = [r.score for q, r in held if q == 0]
    good = [r.score for q, r in held if q == 1]
    assert max(np.mean(bad), 0) < 0.2 and np.mean(good) > 0.9


def test_held_out_labels_do_not_matter(spark, documents, labels):
    from pyspark.sql import functions as F

    from orderloom.llm.common import held_out

    flipped = labels.withColumn(
        "quality", F.when(held_out("doc_id", 3, 1), 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    assert quality.fit(documents, labels) == quality.fit(documents, flipped)


def test_lasso_keeps_few_rules():
    rng = np.random.default_rng(2)
    x = {"a": rng.random(2000), "b": rng.random(2000), "noise": rng.random(2000)}
    y = ((x["a"] > 0.7) & (x["b"] <= 0.4)).astype(float)
    model = quality.train(x, y)
    total = np.full(2000, model.bias)
    for rule, weight in model.rules:
        hit = np.ones(2000, dtype=bool)
        for condition in rule:
            hit &= condition.mask(x)
        total += weight * hit
    assert ((total >= 0) == y).mean() > 0.98
    assert len(model.rules) < 40


def test_one_label_or_none():
    assert quality.train({"a": np.zeros(0)}, np.zeros(0)).bias == 0
    assert quality.train({"a": np.arange(5.0)}, np.ones(5)).rules == ()


def test_odd_rows(spark, make, odd_rows):
    labels = spark.createDataFrame(
        [(7, 1), (7, 0), (8, 0), (None, 1), (9, None), (12, 0), (999, 1)], "doc_id long, quality int"
    )
    got = quality.classify(make(odd_rows), labels).collect()
    assert len(got) == len(odd_rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    empty = quality.classify(make([]), labels)
    assert empty.collect() == []
    none = quality.classify(make(odd_rows), labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}


def test_statistics_of_a_text(spark):
    text = "Ab cd!!\nAb cd!!\nx1 $$"
    df = spark.createDataFrame([(text,), (None,)], "t string")
    stats = df.select(quality.statistics(df.t).alias("s")).select("s.*").collect()
    assert stats[0]["words"] == 6 and stats[0]["upper"] == 2 / len(text)
    assert stats[0]["distinct_lines"] == 2 / 3 and stats[0]["distinct_words"] == 4 / 6
    assert stats[1]["words"] == 0 and stats[1]["mean_word"] == 0


def test_compiled_rules_agree_with_the_model(spark):
    rng = random.Random(3)
    rows = [(k, "w " * rng.randint(0, 40) + "! " * rng.randint(0, 40)) for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    stats = docs.select("doc_id", quality.statistics(docs.text).alias("s")).select("doc_id", "s.*")
    data = stats.toPandas().set_index("doc_id").sort_index()
    x = {c: data[c].to_numpy(dtype=float) for c in data.columns}
    model = quality.train(x, (data["sentence_marks"] > 0.2).to_numpy(dtype=float) * 0 + (x["symbols"] < 0.2))
    total = np.full(len(data), model.bias)
    for rule, weight in model.rules:
        hit = np.ones(len(data), dtype=bool)
        for condition in rule:
            hit &= condition.mask(x)
        total += weight * hit
    scored = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    assert np.allclose([scored[k] for k in range(200)], 1 / (1 + np.exp(-total)))
