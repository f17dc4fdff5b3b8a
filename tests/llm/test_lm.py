import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from orderloom.llm import lm


def tokens(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


class Once(Counter):
    """Counts whose sum is worked out once."""

    def values(self):
        if not hasattr(self, "total_values"):
            self.total_values = [sum(super().values())]
        return self.total_values


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def learn(rows, order):
    """Counts of the n-grams of every length up to ``order``; START is False, END is None."""
    counts = [Counter() for _ in range(order)]
    for i, text, *_ in rows:
        if not held(i):
            t = [False, *tokens(text)]
            for k in range(order):
                counts[k].update(tuple(t[j - k : j + 1]) for j in range(max(1, k), len(t)))
    return counts


def estimate(counts, context, w, m):
    """The smoothed probability of ``w`` after a context, by recursion over shorter ones."""
    if not context:
        return (counts[0][(w,)] + 1) / (sum(counts[0].values()) + len(counts[0]) + 1)
    seen = counts[0][(None,)] if context == (False,) else counts[len(context) - 1][context]
    return (counts[len(context)][(*context, w)] + m * estimate(counts, context[1:], w, m)) / (seen + m)


def expected(rows, order=lm.ORDER, m=lm.STRENGTH):
    """(id, held out, tokens, known, all, base, score) of every row."""
    counts = learn(rows, order)
    n, out, known = sum(counts[0].values()), [], {}

    def p(context, w):
        if (context, w) not in known:
            known[context, w] = math.log10(estimate(counts, context, w, m))
        return known[context, w]

    counts[0] = Once(counts[0])
    for i, text, *_ in rows:
        t = [False, *tokens(text)]
        base = sum(p((), w) for w in t[1:])
        score = sum(p(tuple(t[max(0, j - order + 1) : j]), t[j]) for j in range(1, len(t)))
        out.append((i, held(i), len(t) - 1, sum(counts[0][(w,)] > 0 for w in t[1:]), n, base, score))
    return out


def agree(df, rows, order=lm.ORDER):
    got = sorted(map(tuple, df.collect()), key=str)
    want = sorted(expected(rows, order), key=str)
    assert [g[:5] for g in sorted(got, key=lambda r: str(r[:5]))] == [
        w[:5] for w in sorted(want, key=lambda r: str(r[:5]))
    ]
    for k in (5, 6):
        assert np.allclose(sorted(g[k] for g in got), sorted(w[k] for w in want))


def test_small_table(documents, small_docs):
    agree(lm.score_documents(documents), small_docs)


def test_odd_rows(make, odd_rows):
    agree(lm.score_documents(make(odd_rows)), odd_rows)
    assert lm.score_documents(make([])).collect() == []


def test_many_blocks(make, small_docs, monkeypatch):
    monkeypatch.setattr(lm, "MB", 1 << 10)
    agree(lm.score_documents(make(small_docs[:80])), small_docs[:80])


def test_nothing_to_learn_from(make):
    rows = [(i, "a b", "en", "a") for i in range(200) if held(i)][:3]
    got = lm.score_documents(make(rows)).collect()
    assert [(r.base_score, r.n_known, r.train_tokens) for r in got] == [(0.0, 0, 0)] * 3


@pytest.mark.parametrize("order", [1, 2, 4])
def test_other_orders(make, small_docs, order):
    agree(lm.score_documents(make(small_docs[:60]), order=order), small_docs[:60], order)


def test_order_below_one(documents):
    with pytest.raises(ValueError, match="one token"):
        lm.score_documents(documents, order=0)


def test_long_texts_are_walked_in_parts(odd_rows, small_docs, monkeypatch):
    """The parts of a text add up to the whole walk, however short they are."""
    texts = [r[1] or "" for r in odd_rows[-40:] + small_docs[:40]] + ["a b c a b"] * 9
    for order in (1, 2, 3, 5):
        block = lm._Block(texts, order, 0)
        totals = block.counts(np.arange(len(texts)) % 3 > 0)
        auto = lm.Automaton(block, totals, int(totals[0].sum()), int((totals[0] > 0).sum()), 20.0)
        monkeypatch.setattr(lm, "WALK", 1 << 30)
        whole = auto.walk()
        for walk in (1, 2, 7):
            monkeypatch.setattr(lm, "WALK", walk)
            assert np.allclose(auto.walk(), whole)


def test_one_long_text_among_many(make):
    rng = random.Random(2)
    rows = [(k, " ".join(rng.choice("abcde") for _ in range(rng.randint(0, 9))), "en", "a") for k in range(300)]
    rows.append((1000, " ".join(rng.choice("abcdefg") for _ in range(90_000)), "en", "a"))
    agree(lm.score_documents(make(rows)), rows)


def test_identical_rows_in_bulk(make):
    rows = [(5, "a b c a b", "en", "a")] * 3000 + [(6, "a b d", "en", "a"), (None, "c a", "en", "a")] * 40
    agree(lm.score_documents(make(rows)), rows)


def test_walk_follows_states_and_failure_arcs():
    """State by state: a known trigram, a failure to a word's state, one to the root, an unknown word."""
    texts = ["a b c", "a b d", "b c b"]
    block = lm._Block([*texts, "a b c x c b d"], 3, 0)
    totals = block.counts(np.array([True, True, True, False]))
    n, v = int(totals[0].sum()), int((totals[0] > 0).sum())
    auto = lm.Automaton(block, totals, n, v, 20.0)
    lengths, state = [], np.array([1])
    for step in range(8):
        _, state = auto.read(block.starts[3:] + step, state)
        lengths.append(int(state[0]))
    # START a | a b | b c | x is unknown | c | c b | b d (the failure arc of c b) | end
    assert lengths == [2, 2, 2, 0, 1, 2, 2, 2]
    counts, t = learn([(None, text) for text in texts], 3), [False, *tokens("a b c x c b d")]
    want = sum(math.log10(estimate(counts, tuple(t[max(0, j - 2) : j]), t[j], 20.0)) for j in range(1, 9))
    assert auto.walk()[3] == pytest.approx(want)


def test_probabilities_after_each_state_add_up_to_one():
    rows = [(k, t) for k, t in enumerate(["a b a", "b c", "a a a b", "c"]) if not held(k)]
    counts = learn(rows, 3)
    contexts = [(), (False,), (False, "a"), ("a", "b"), ("a", "a"), ("c",), ("x", "a")]
    for context in contexts:
        total = sum(estimate(counts, context, w, 20.0) for (w,) in counts[0])
        assert total + estimate(counts, context, "never seen", 20.0) == pytest.approx(1)


def test_packed_numbers_come_back():
    rng = np.random.default_rng(1)
    for values in ([], [5], [2**64 - 1], [0, 1], np.unique(rng.integers(0, 2**64 - 1, 999, dtype=np.uint64))):
        keys = np.array(values, dtype=np.uint64)
        assert (lm._from_keys(lm._keys(keys)) == keys).all()
        short = np.unique(keys >> np.uint64(17) << np.uint64(17))
        assert (lm._from_keys(lm._keys(short, 17), 17) == short).all()
    for values in ([], [0], [255, 256], [2**40]):
        assert lm._from_numbers(lm._numbers(np.array(values, dtype=np.int64))).tolist() == values


def test_held_out_text_is_likelier_than_by_words_alone(documents):
    got = [r for r in lm.score_documents(documents).collect() if r.held_out]
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_longer_contexts_make_held_out_text_likelier(documents):
    def held_out_score(order):
        return sum(r.score for r in lm.score_documents(documents, order=order).collect() if r.held_out)

    two, three = held_out_score(2), held_out_score(3)
    assert three > two


def test_a_block_is_scored_in_little_memory():
    rng = np.random.default_rng(1)
    texts = [" ".join(map(str, rng.zipf(1.3, 2000) % 50_000)) for _ in range(100)]
    docs = pd.DataFrame({"doc_id": [str(i) for i in range(100)], "text": texts, "held_out": False, "block": 0})
    answers = lm._answer(3, 20)(lm._ask(3, 20, 64)(docs))
    answers = answers[["block", "part", "counts0", "counts1", "counts2"]]
    tracemalloc.start()
    scored = lm._score(3, 20, lm.STRENGTH, 200_000, 50_000)(docs, answers)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert list(scored["n_tokens"]) == [2001] * 100
    assert peak < 105 * scored["n_tokens"].sum()
