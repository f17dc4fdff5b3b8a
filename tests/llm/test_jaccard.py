import random

import numpy as np
import pytest

from orderloom.llm import jaccard
from orderloom.llm.hashing import shingle_hashes, word_hashes


def shingles(text, width):
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if len(words) < width:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[k : k + width]) for k in range(len(words) - width + 1))


def expected(rows, width, num, den):
    """(id, set size, smallest id reachable) of every row, comparing all pairs."""
    sets = [shingles(r[1], width) for r in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if common * den >= (len(sets[a]) + len(sets[b]) - common) * num:
                    parent[find(a)] = find(b)
    least = {}
    for k, r in enumerate(rows):
        if r[0] is not None:
            least[find(k)] = min(least.get(find(k), r[0]), r[0])
    return sorted(
        ((r[0], len(s), least.get(find(k)) if s else r[0]) for k, (r, s) in enumerate(zip(rows, sets, strict=True))),
        key=str,
    )


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def edited(rng, base, edits):
    words = base.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def near_copies(seed, groups=12, boilerplate=True):
    rng = random.Random(seed)
    shared = " ".join(f"s{k}" for k in range(60))
    rows = []
    for g in range(groups):
        base = " ".join(f"g{g}x{rng.randrange(500)}" for _ in range(rng.randint(8, 120)))
        for _ in range(rng.randint(1, 9)):
            text = edited(rng, base, rng.randint(0, 4))
            rows.append((len(rows), text + (" " + shared) * (boilerplate and rng.random() < 0.4), "en", "a"))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("width,num", [(3, 90), (5, 80)])
def test_near_copies_against_all_pairs(make, width, num):
    rows = near_copies(width)
    assert got(jaccard.join(make(rows), width=width, num=num)) == expected(rows, width, num, 100)


def test_large_clusters_and_buckets(make, monkeypatch):
    """With tiny limits all goes through centres and pairs of blocks."""
    monkeypatch.setattr(jaccard, "BUCKET", 2)
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    rng = random.Random(8)
    base = " ".join(f"b{k}" for k in range(60))
    rows = [(k, edited(rng, base, rng.randint(0, 5)), "en", "a") for k in range(60)]
    rows += [(100 + k, *r[1:]) for k, r in enumerate(near_copies(5, 4))]
    for num in (70, 80, 90):
        assert got(jaccard.join(make(rows), width=3, num=num)) == expected(rows, 3, num, 100)


def test_odd_rows(make, odd_rows):
    assert got(jaccard.join(make(odd_rows), width=3, num=90)) == expected(odd_rows, 3, 90, 100)
    assert jaccard.join(make([])).collect() == []


def test_threshold_is_met_exactly(make):
    """9 of 10 shingles in common, and just below."""
    a = " ".join(f"t{k}" for k in range(12))
    rows = [(1, a, "en", "a"), (2, " ".join(a.split()[:11]), "en", "a"), (3, " ".join(a.split()[:10]), "en", "a")]
    assert got(jaccard.join(make(rows), width=3, num=90)) == expected(rows, 3, 90, 100)


def test_one_document_of_each_group_stays(make, odd_rows):
    rows = near_copies(2)
    kept = {r.doc_id for r in jaccard.distinct_documents(make(rows)).collect()}
    assert kept == {c for _, _, c in expected(rows, 5, 80, 100)}
    df = make(odd_rows)
    out = jaccard.distinct_documents(df)
    assert out.columns == df.columns
    sets = {(r.text or "").lower() for r in out.collect()}
    assert out.where("doc_id = 7 or text is null").count() >= 2
    assert {(r[1] or "").lower() for r in odd_rows if len(shingles(r[1], 5)) <= 1} <= sets


def test_prefixes_share_as_many_as_they_ask(monkeypatch):
    """Two sets above the threshold share the smaller number asked for, however it is chosen."""
    rng = np.random.default_rng(0)
    for trial in range(300):
        universe = rng.integers(1, 2**63, 400, dtype=np.uint64)
        df_of = {int(u): int(rng.integers(1, 50)) for u in universe}
        n = int(rng.integers(1, 200))
        a = np.unique(rng.choice(universe, n))
        b = np.unique(np.concatenate([a[rng.random(len(a)) > 0.06], rng.choice(universe, trial % 4)]))
        common = len(np.intersect1d(a, b))
        if not len(b) or 100 * common < 80 * (len(a) + len(b) - common):
            continue
        (ma, pa), (mb, pb) = (
            jaccard.prefix(s, np.array([df_of[int(x)] for x in s], np.uint32), 80, 100) for s in (a, b)
        )
        assert len(np.intersect1d(pa, pb)) >= min(ma, mb)


def test_hashes_do_not_depend_on_the_pieces(monkeypatch):
    from orderloom.llm import hashing

    texts = ["a b\tc", None, "", "x" * 5000 + " y", "é ö  z", "A B C"] + [f"w{k} " * 50 for k in range(9)]
    whole, bounds = word_hashes(texts)
    for piece in (16, 64, 1000):
        monkeypatch.setattr(hashing, "PIECE", piece)
        hashing._tables.cache_clear()
        again, bounds_again = word_hashes(texts)
        assert (whole == again).all() and (bounds == bounds_again).all()
    monkeypatch.undo()
    hashing._tables.cache_clear()
    assert (whole[:3] == whole[bounds[5] : bounds[6]]).all()
    assert len(shingle_hashes(whole[:0], 3)) == 0


def test_chance_meetings_send_no_sets(make, monkeypatch):
    """Sets that share a few frequent shingles, which the counts cannot tell from rare ones."""
    sent, whole = [], jaccard._sets

    def sets(texts, wanted, width):
        sent.extend(r.doc_id for r in wanted.select("doc_id").collect())
        return whole(texts, wanted, width)

    monkeypatch.setattr(jaccard, "BUCKET", 4)
    monkeypatch.setattr(jaccard, "_sets", sets)
    table = np.ones(jaccard.SLICES * jaccard.SLICE, np.uint32)
    monkeypatch.setattr(jaccard, "frequency_table", lambda *_: table)
    rng = random.Random(3)
    shared = " ".join(f"u{k}" for k in range(14))
    rows = [
        (k, " ".join(f"d{k}x{j}" for j in range(60)) + " " + shared, "en", "a") for k in range(50)
    ]
    base = " ".join(f"b{k}" for k in range(200))
    rows += [(100 + k, edited(rng, base, 1), "en", "a") for k in range(12)]
    assert got(jaccard.join(make(rows), width=3, num=90)) == expected(rows, 3, 90, 100)
    assert sorted(sent) == list(range(100, 112))


@pytest.mark.parametrize("matches,each,num", [(1, 1000, 40), (3, 8, 80)])
def test_large_buckets_in_blocks_of_bits(make, monkeypatch, matches, each, num):
    """Frequent shingles all over, parts of buckets that a pivot does not reach, sets of many sizes."""
    monkeypatch.setattr(jaccard, "BUCKET", 2)
    monkeypatch.setattr(jaccard, "BITS_BLOCK", 3)
    monkeypatch.setattr(jaccard, "MATCHES", matches)
    monkeypatch.setattr(jaccard, "MATCHES_EACH", each)
    table = np.ones(jaccard.SLICES * jaccard.SLICE, np.uint32)
    monkeypatch.setattr(jaccard, "frequency_table", lambda *_: table)
    rng = random.Random(matches)
    base = [f"b{k}" for k in range(150)]
    rows = []
    for k in range(90):
        start = rng.randrange(40)
        part = " ".join(base[start : start + rng.randint(20, 110)])
        rows.append((k, edited(rng, part, rng.randint(0, 3)), "en", "a"))
    rows += [(200 + k, *r[1:]) for k, r in enumerate(near_copies(6, 4))]
    assert got(jaccard.join(make(rows), width=2, num=num)) == expected(rows, 2, num, 100)


def test_bits_differ_in_no_more_places_than_sets(spark):
    rng = np.random.default_rng(5)
    nodes, pairs, true = [], [], set()
    for k in range(0, 120, 2):
        a = np.unique(rng.integers(1, 2**63, int(rng.integers(1, 400)), dtype=np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) > k / 400], rng.choice(a, 1)]))
        b = np.unique(np.concatenate([b, rng.integers(1, 2**63, k // 8, dtype=np.uint64)]))
        nodes += [(k + i, len(s), bytearray(jaccard.parity_bits(s))) for i, s in enumerate((a, b))]
        pairs += [(k, k + 1), (k, (k + 7) % 120)]
        common = len(np.intersect1d(a, b))
        if 100 * common >= 70 * (len(a) + len(b) - common):
            true.add((k, k + 1))
    nodes = spark.createDataFrame(nodes, "set_id long, n long, bits binary")
    found = jaccard._possible(spark.createDataFrame(pairs, "a long, b long"), nodes, 70, 100)
    found = {(r.a, r.b) for r in found.collect()}
    assert true <= found
    assert all(b == a + 1 for a, b in found)
