import random
import re

import pytest

import corpus_pipeline as cp
from orderloom.llm import common, mixing, pieces, quality
from orderloom.llm.common import components, numbered, table

SF = "/root/testdata/sf0.001"


def test_stages_in_order(spark):
    """Each stage against a plain version on its own input."""
    docs = table(spark, SF, "documents")
    columns = docs.columns
    stages = dict(cp.STAGES)
    assert [name for name, _ in cp.STAGES] == [
        "quality classifier", "n-gram Jaccard join", "personal data", "mixing sources", "SentencePiece",
    ]
    rows = docs.collect()

    good = stages["quality classifier"](spark, docs, SF)
    model = quality.fit(docs, table(spark, SF, "labels"))
    scores = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    kept = good.collect()
    assert good.columns == columns
    assert sorted(map(str, kept)) == sorted(str(r) for r in rows if scores[r.doc_id] >= 0.5)
    assert len(kept) > 0.7 * len(rows)

    from tests.llm.test_jaccard import expected

    good = good.cache()
    single = stages["n-gram Jaccard join"](spark, good, SF).cache()
    groups = expected([(r.doc_id, r.text) for r in kept], 5, 80, 100)
    assert sorted(r.doc_id for r in single.collect()) == sorted({c for _, _, c in groups})
    assert single.columns == columns

    masked = stages["personal data"](spark, single, SF).cache()
    assert masked.columns == columns
    before = {r.doc_id: r.text for r in single.collect()}
    for r in masked.collect():
        assert r.n_chars == len(r.text)
        assert not re.search(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.", r.text)
        if not re.search(r"[0-9@]", before[r.doc_id]):
            assert r.text == before[r.doc_id]

    mixed = stages["mixing sources"](spark, masked, SF)
    assert mixed.columns == columns
    times = {r.doc_id: r.times for r in mixing.mix(masked).collect()}
    count = {}
    for r in mixed.collect():
        count[r.doc_id] = count.get(r.doc_id, 0) + 1
    assert count == {k: n for k, n in times.items() if n}

    last = stages["SentencePiece"](spark, mixed, SF)
    assert set(columns) < set(last.columns)
    ids = {r.doc_id: r.piece_ids for r in last.collect()}
    vocabulary = pieces.Vocabulary.load()
    assert all(pieces.decode(vocabulary, ids[r.doc_id]) == r.text for r in mixed.collect())


def test_odd_rows_pass_all_stages(spark, make, odd_rows):
    docs = make(odd_rows)
    for name, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == make(odd_rows).columns, name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    last = cp.STAGES[-1][1](spark, docs, SF)
    assert {"a.b", "__text", "piece_ids"} < set(last.columns) and "Piece_Ids" not in last.columns
    rows = last.select("piece_ids", "`a.b`", "__text").collect()
    assert len(rows) == docs.count() and {(r["a.b"], r["__text"]) for r in rows} == {("x", "x")}


@pytest.mark.parametrize("k", range(5))
def test_an_empty_table(spark, make, k):
    assert cp.STAGES[k][1](spark, make([]), SF).collect() == []


def test_components_against_search(spark):
    rng = random.Random(1)
    for _ in range(3):
        edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(rng.choice([60, 150, 400]))]
        edges += [(1000 + k, 1001 + k) for k in range(40)] + [(5, None), (None, None), (7, 7)]
        parent = {}

        def find(x):
            parent.setdefault(x, x)
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in edges:
            if a is not None and b is not None and a != b:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
        got = components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
        assert {(r.node, r.root) for r in got} == {(x, find(x)) for x in parent}
        assert len(got) == len(parent)


def test_rows_are_numbered_where_ids_do_not_tell(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b")], "doc_id long, _row string")
    rows, name = numbered(df, "doc_id")
    assert name not in df.columns and len({r[name] for r in rows.collect()}) == 3
    assert numbered(df.where("_row = 'b'").fillna(3), "doc_id")[1] == "doc_id"


def random_graph(rng):
    """Edges with nulls, loops, repeats, a hub and long paths, and the smallest node each reaches."""
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(rng.choice([60, 150, 400]))]
    edges += [(1000 + k, 1001 + k) for k in range(40)] + [(2**62, 5000 + k) for k in range(30)]
    edges += [(-3, 1020), (-3, 1020), (5, None), (None, None), (7, 7)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return edges, {(x, find(x)) for x in parent}


@pytest.mark.parametrize("few", [0, 30, 10**6])
def test_components_by_rounds_and_in_one_pass(spark, monkeypatch, few):
    monkeypatch.setattr(common, "FEW_LINKS", few)
    edges, wanted = random_graph(random.Random(2))
    got = components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    assert len(got) == len(wanted) and {(r.node, r.root) for r in got} == wanted
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").collect() == []


def test_few_links_take_no_rounds(spark, monkeypatch):
    """Each round of a path this long is five shuffles over next to no rows."""
    written, write = [], common.saved

    def counted(df, label):
        written.append(label)
        return write(df, label)

    monkeypatch.setattr(common, "saved", counted)
    edges = spark.createDataFrame([(k, k + 1) for k in range(500)], "a long, b long")
    assert {r.root for r in components(edges, "a", "b").collect()} == {0}
    assert len(written) == 2
