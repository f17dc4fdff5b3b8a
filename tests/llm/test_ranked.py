import math
import random
import re
from collections import Counter

import numpy as np

from orderloom.llm import ranked
from orderloom.llm.common import table

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms_of(text):
    return Counter(TERM.findall((text or "").translate(LOWER)))


def brute(docs, items, k=10):
    counted = [(d[0], terms_of(d[1])) for d in docs]
    counted = [(i, c, c.total()) for i, c in counted if c]
    total, length = len(counted), sum(n for *_, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    weight = {t: math.floor(1000 * math.log((2 * total + 2) / (2 * n + 1))) for t, n in df.items()}
    out = []
    for item_id, text in items:
        asked, scored = terms_of(text), []
        for doc_id, found, n in counted:
            m = 100 - 75 + (75 * n * total) // length
            score = sum(
                times * weight[t] * ((10**9 * found[t]) // (1000 * found[t] + 8 * m))
                for t, times in asked.items()
                if t in found
            )
            if score > 0:
                scored.append((doc_id, score))
        scored.sort(key=lambda s: (-s[1], s[0] is None, s[0] or 0))
        out += [(item_id, rank + 1, *s) for rank, s in enumerate(scored[:k])]
    return sorted(out, key=str)


def result(df):
    return sorted([tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()], key=str)


def items_of(spark, rows):
    return spark.createDataFrame([(*r, "x", "x") for r in rows], "item_id long, text string, `a.b` string, item string")


def test_tables_as_brute_force(spark):
    docs, items = (table(spark, "/root/testdata/sf0.001", t) for t in ("documents", "benchmark"))
    expected = brute(
        [tuple(r) for r in docs.select("doc_id", "text").collect()],
        [tuple(r) for r in items.select("item_id", "text").collect()],
    )
    assert result(ranked.search(docs, items)) == expected


def test_odd_rows(spark, make, odd_rows):
    items = [
        (1, "one id ONE é😀 x1 x1"), (1, "one id ONE é😀 x1 x1"), (2, None), (3, ""), (4, " .,- "),
        (None, odd_rows[7][1]), (5, odd_rows[12][1]), (6, "日本 é\u0000😀 ▁"), (7, "nobody-has-these"), (2**60, "x" * 200_000),
    ]
    assert result(ranked.search(make(odd_rows), items_of(spark, items))) == brute(odd_rows, items)
    assert result(ranked.search(make([]), items_of(spark, items))) == []
    assert result(ranked.search(make(odd_rows), items_of(spark, []))) == []


def corpus(n, seed):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(60)]
    weights = [1 / (k + 1) for k in range(60)]
    docs = [(k, " ".join(rng.choices(words, weights, k=rng.choice([3, 5, 5, 8, 40, 300])))) for k in range(n)]
    return docs + [(n + k, "w1 w1 w2 same words") for k in range(50)], [
        (k, " ".join(rng.choices(words, k=rng.randint(1, 12)))) for k in range(30)
    ]


def test_small_indexes_and_blocks(spark, make, monkeypatch):
    """Many indexes per task, visits of few documents, items in several blocks: the same rows."""
    docs, items = corpus(600, 2)
    for name, value in {"POSTINGS": 300, "VISIT": 4, "ITEMS": 8}.items():
        monkeypatch.setattr(ranked, name, value)
    frame = make([(i, t, "en", "a") for i, t in docs])
    assert result(ranked.search(frame, items_of(spark, items))) == brute(docs, items)


def test_long_texts_in_pieces(monkeypatch):
    rng = random.Random(7)
    text = "".join(rng.choice(["ab", "É", "Z9", " ", ".", "日", "\n", "c" * 40]) for _ in range(3000))
    whole = ranked.term_counts(text)
    assert {t.decode(): n for t, n in whole.items()} == terms_of(text)
    for size in (1, 2, 7, 64):
        monkeypatch.setattr(ranked, "PIECE", size)
        assert ranked.term_counts(text) == whole


def test_visits_end_before_strata_that_cannot_win(monkeypatch):
    """Enough short documents hold the term; strata of long documents are never summed up."""
    monkeypatch.setattr(ranked, "VISIT", 12)
    short, many = 12, 5_000
    m = np.concatenate([np.full(short, 30), 100 + np.arange(many) % 50])
    sizes = np.ones(short + many, np.int64)
    index = ranked.Index(m, sizes, np.zeros(short + many, np.int32), np.ones(short + many, np.int64), 1)
    key = np.arange(short + many)
    docs, scores = index.search(np.array([0]), np.array([1000]), 1, 10, key)
    assert docs.tolist() == list(range(10)) and len(set(scores.tolist())) == 1
    index.impact[short:] = 10**9  # would win if any of these was looked at
    again, _ = index.search(np.array([0]), np.array([1000]), 1, 10, key)
    assert again.tolist() == list(range(10))


def test_impacts_rise_with_the_count():
    tf = np.arange(1, 500)
    for m in (25, 100, 90_000):
        assert (np.diff(ranked.impacts(tf, np.full(len(tf), m))) >= 0).all()
