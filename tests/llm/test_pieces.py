import random

import pytest
import sentencepiece

from orderloom.llm import pieces


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary.load()


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.VOCABULARY)


def texts(seed, count=1500):
    rng = random.Random(seed)
    some = list("abeint ▁.-=*\n\t日é😀²0") + ["the ", "tion", "  ", "====", "include", "\x00"]
    out = ["", None, " ", "  a  b ", "x" * 3000, " " * 70, "\n\n", "▁▁a", "<s> <unk> <0x41>", "a\ud83d b"[:1]]
    out += ["".join(rng.choice(some) for _ in range(rng.randint(1, 50))) for _ in range(count)]
    out += ["".join(chr(rng.choice([rng.randint(1, 0x2FF), rng.randint(0x400, 0x9FFF)])) for _ in range(30))
            for _ in range(200)]
    return out


def test_encodes_and_decodes_like_the_library(vocabulary, library, small_docs):
    every = texts(1) + [r[1] for r in small_docs]
    ids, bounds = pieces.Encoder(vocabulary).encode(every)
    for text, a, b in zip(every, bounds[:-1], bounds[1:], strict=True):
        own = ids[a:b].tolist()
        assert own == library.encode(text or "")
        assert pieces.decode(vocabulary, own) == library.decode(own)


def test_forgetting_changes_nothing(vocabulary, monkeypatch):
    every = texts(2, 300)
    whole = pieces.Encoder(vocabulary).encode(every)[0].tolist()
    monkeypatch.setattr(pieces, "KEPT", 50)
    monkeypatch.setattr(pieces, "BATCH", 40)
    encoder = pieces.Encoder(vocabulary)
    again = [x for k in range(0, len(every), 7) for x in encoder.encode(every[k : k + 7])[0].tolist()]
    assert again == whole


def test_unigram_models_take_the_best_sum():
    """Against all ways to cut a text."""
    words = ["a", "b", "c", "ab", "bc", "abc", "▁", "▁a", "▁ab", "ca"]
    scores = [-3.0, -3.1, -3.3, -4.0, -4.5, -7.05, -1.0, -3.2, -6.0, -5.2]
    v = pieces.Vocabulary(["<unk>", *words], [0.0, *scores], list(range(1, 11)), [], 0, False)
    rank = dict(zip(words, scores, strict=True))
    rng = random.Random(3)
    every = ["".join(rng.choice("abc ") for _ in range(rng.randint(1, 9))) for _ in range(200)]
    ids, bounds = pieces.Encoder(v).encode(every)

    def best(text):
        top = [0.0] + [float("-inf")] * len(text)
        for e in range(1, len(text) + 1):
            for b in range(e):
                if text[b:e] in rank:
                    top[e] = max(top[e], top[b] + rank[text[b:e]])
        return top[-1]

    for text, a, b in zip(every, bounds[:-1], bounds[1:], strict=True):
        full = "▁" + text.replace(" ", "▁")
        found = [v.pieces[i] for i in ids[a:b]]
        assert "".join(found) == full
        assert sum(rank[p] for p in found) == pytest.approx(best(full))


def test_suffix_order_and_ranges():
    import numpy as np

    text = "abracadabra\x00banana\x00"
    codes = np.array([ord(c) for c in text])
    order, _ = pieces.suffix_ranks(codes, 4)
    assert [text[i : i + 4] for i in order] == sorted(text[i : i + 4] for i in range(len(text)))
    words = ["a", "an", "abra", "x", "na"]
    symbols = np.zeros((5, 4), dtype=np.int64)
    for k, w in enumerate(words):
        symbols[k, : len(w)] = [ord(c) for c in w]
    low, high = pieces.occurrences(codes, order, symbols, np.array([len(w) for w in words]))
    for w, a, b in zip(words, low, high, strict=True):
        assert sorted(order[a:b]) == [i for i in range(len(text)) if text.startswith(w, i)]


def test_documents(make, odd_rows, library):
    df = make(odd_rows)
    out = pieces.encode_documents(df, out="ids")
    rows = out.collect()
    assert len(rows) == len(odd_rows) and set(df.columns) <= set(out.columns)
    for r in rows:
        assert r.ids == library.encode(r.text or "") and r.n_pieces == len(r.ids)
        assert r.round_trip == ("▁" not in (r.text or ""))
    back = pieces.decode_documents(out.drop("text"), ids_col="ids").collect()
    assert sorted(r.text for r in back) == sorted((r[1] or "").replace("▁", " ") for r in odd_rows)
    assert pieces.encode_documents(make([])).collect() == []


def test_merging_is_leftmost_best_first():
    rank = {"ab": -1.0, "bc": -0.5, "abc": -2.0, "aa": -1.0, "aaa": -3.0, "bca": -1.5}
    v = pieces.Vocabulary(["<unk>", *rank], [0.0, *rank.values()], list(range(1, 7)), [], 0, True)

    def slow(text):
        parts = list(text)
        while True:
            some = [(rank.get(a + b), -k) for k, (a, b) in enumerate(zip(parts[:-1], parts[1:], strict=True))]
            some = [s for s in some if s[0] is not None]
            if not some:
                return parts
            k = -max(some)[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]

    rng = random.Random(5)
    for _ in range(500):
        text = "".join(rng.choice("abcx") for _ in range(rng.randint(0, 9)))
        assert v.merged(text) == slow(text)


def test_memory_stays_bounded_on_words_that_come_once(vocabulary, library):
    """Each group holds 40,000 words that no other has, beside some that all have."""
    import tracemalloc

    rng = random.Random(6)
    encoder = pieces.Encoder(vocabulary)
    tracemalloc.start()
    for _ in range(10):
        text = " ".join("".join(rng.choice("abcdefghij") for _ in range(9)) for _ in range(40_000))
        ids, _ = encoder.encode([text, "all have these"])
        assert ids[-3:].tolist() == library.encode("all have these")[-3:]
        assert len(encoder.place) <= pieces.KEPT
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert "▁these" in encoder.place and len(encoder.follows) <= 2 * pieces.FOLLOWS
    assert peak < 110e6, peak


def test_a_text_reaches_python_once(make):
    df = make([(1, "a text", "en", "a")]).select("doc_id", "text")

    def sent(out):
        (plan,) = [x for x in out._jdf.queryExecution().analyzed().toString().split("\n") if "MapInArrow" in x]
        return plan.split("run(")[1].split(")")[0].count("#")

    assert sent(pieces.encode_documents(df)) == 2
    replaced = pieces.encode_documents(df, out="text")
    assert sent(replaced) == 2 and replaced.first().n_pieces == len(replaced.first().text)
