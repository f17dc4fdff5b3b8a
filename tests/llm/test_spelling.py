import itertools
import random
import re
import zlib
from collections import Counter

import pytest

from orderloom.llm import spelling
from orderloom.llm.common import table

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def edits(word, letters):
    """All words one code point away."""
    cuts = [(word[:k], word[k:]) for k in range(len(word) + 1)]
    out = {a + b[1:] for a, b in cuts if b}
    out |= {a + c + b for a, b in cuts for c in letters}
    out |= {a + c + b[1:] for a, b in cuts if b for c in letters}
    return out - {word}


def brute(rows, shortest=6, fewest=5, ratio=5):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= shortest and n >= fewest}
    letters = sorted(set("".join(words)))
    near = {w: [v for v in edits(w, letters) if v in words] for w in words}
    forms = {}
    for w, n in words.items():
        if near[w]:
            top = min(near[w], key=lambda v: (-words[v], v))
            if words[top] >= ratio * n:
                forms[w] = top
    out = set()
    for w, n in words.items():
        root = w
        while root in forms:
            root = forms[root]
        out.add((w, n, len(near[w]), forms.get(w), words.get(forms.get(w)), root))
    return out


def result(df):
    return {tuple(r) for r in df.select("word", "n", "n_near", "form", "form_n", "root").collect()}


def texts_of(counts):
    return [(k, f"{word}. " * n, "en", "a") for k, (word, n) in enumerate(counts)]


def test_documents_as_brute_force(spark, make, small_docs):
    assert result(spelling.variants(table(spark, "/root/testdata/sf0.001", "documents"))) == brute(small_docs)


def test_odd_rows(make, odd_rows):
    rows = odd_rows + [(None, "abcdef Abcdef abcdeg " * 5, "en", None)] * 2
    assert result(spelling.variants(make(rows))) == brute(rows)
    assert result(spelling.variants(make([]))) == set()
    assert result(spelling.variants(make([(1, None, "en", "a"), (2, "", "en", "a"), (3, "12 ?", "en", "a")]))) == set()


def test_few_letters_and_repeated_grams(make):
    """Words of two letters: bigrams repeat, tie and overlap, and all words are close."""
    rng = random.Random(3)
    words = ["".join(p) for p in itertools.product("ab", repeat=6)] + ["aaaaaaa", "abababa", "éaaaaa", "×÷aaaa"]
    rows = texts_of([(w, rng.choice([5, 6, 30, 200])) for w in rng.sample(words, 50)])
    assert result(spelling.variants(make(rows))) == brute(rows)


def test_every_kind_of_edit_at_every_place(make):
    word, letters = "straßenbahn", "xs"
    variants = sorted(edits(word, letters))
    rows = texts_of([(word, 900), *[(v, 5) for v in variants]])
    found = {r[0]: r for r in result(spelling.variants(make(rows)))}
    assert found[word][2] == len([v for v in variants if v in found]) > 40
    assert all(found[v][3] == found[v][5] == word for v in variants if v in found)
    assert set(found.values()) == brute(rows)


def test_forms_lead_to_the_root_and_ties_go_by_code_point(make):
    rows = texts_of([("aaaaaa", 5), ("aaaaab", 30), ("aaaabb", 160), ("aaabbb", 900), ("aabbbb", 4600)])
    rows += texts_of([("zzzzzz", 5), ("zzzzzé", 50), ("zzzzzy", 50)])
    found = {r[0]: r for r in result(spelling.variants(make(rows)))}
    assert set(found.values()) == brute(rows)
    assert found["aaaaaa"][5] == "aabbbb" and found["zzzzzz"][3] == "zzzzzy"


def test_pivots_are_disjoint_and_rarest():
    rng = random.Random(1)
    for _ in range(300):
        word = "".join(rng.choice("abc") for _ in range(rng.randint(6, 12)))
        grams = sorted({word[p : p + 2] for p in range(len(word) - 1)}, key=lambda g: rng.random())
        prefix = spelling.prefix_grams(word, {g: k for k, g in enumerate(grams)})
        assert len(prefix) >= 3
        pairs = [(a, b) for a, b in itertools.combinations(prefix, 2) if abs(a[0] - b[0]) >= 2]
        chosen = spelling.pivots(prefix)
        assert abs(chosen[0][0] - chosen[1][0]) >= 2
        assert sum(r for _, r in chosen) == min(a[1] + b[1] for a, b in pairs)


def test_parameters(make):
    rows = texts_of([("abcd", 2), ("abce", 4), ("abc", 9)])
    assert result(spelling.variants(make(rows), shortest=4, fewest=2, ratio=2)) == brute(rows, 4, 2, 2)
    with pytest.raises(ValueError):
        spelling.variants(make(rows), shortest=2)


def test_sides_one_edit_apart_share_a_key_and_others_rarely():
    """Before, the first or the last code point alone was the key: all words with it met."""
    for side in ["", "a", "ab", "aa", "abc", "aab", "abcd", "abcde", "ababab", "straßen"]:
        keys = set(spelling.side_keys("th", side))
        assert all(keys & set(spelling.side_keys("th", other)) for other in edits(side, "abxß"))
    far = [set(spelling.side_keys("th", side)) for side in ("entional", "evvvvvvl", "ewwwwwl", "exxxxxxxl")]
    assert not any(a & b for a, b in itertools.combinations(far, 2))


def test_only_what_is_read_again_is_written(make, monkeypatch):
    """Before, pairs were written, and the forms of all words once a round."""
    written = []

    def saved(df, label):
        out = kept(df, label)
        written.append((label, out.count()))
        return out

    kept = spelling.saved
    monkeypatch.setattr(spelling, "saved", saved)
    rows = texts_of([("aaaaaa", 5), ("aaaaab", 30), ("aaaabb", 160), ("zzzzzz", 5), ("zzzzzy", 50)])
    assert result(spelling.variants(make(rows))) == brute(rows)
    assert [label for label, _ in written] == ["words", "grams", "described", "forms", "forms"]
    assert [n for label, n in written if label == "forms"] == [1, 0]
