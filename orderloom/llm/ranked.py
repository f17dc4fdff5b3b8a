"""Ranked lexical search over a length-stratified index.

A term's part of a document's score depends on the document only by its normaliser ``m`` (from its
length) and the term's count ``tf``. So the index groups documents by equal ``m`` into strata, and
a term's postings within a stratum by ``tf``: the impact of a pair (``m``, ``tf``) is worked out once
for all its documents. The largest ``tf`` of a term in a stratum bounds its part there; the sum of an
item's bounds orders the strata, and the visit ends at the first that cannot reach the item's
k-th best document so far.

Every task indexes the documents of its own partition, some at a time, so documents are not
shuffled: a term's weight needs only the number of documents that hold it, which is counted before.
Items come in blocks of bounded size, one pass over the documents each.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import groups_of, saved, top_per_key

TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
BREAK = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
PIECE = 1 << 20
# Items of a block, bytes of their texts; postings of an index; documents of a first visit.
ITEMS, ITEM_BYTES = 4_096, 1 << 25
POSTINGS = 2_000_000
VISIT = 512


def term_counts(text: str | None) -> Counter:
    """How often the text has each term (maximal runs of ASCII letters and digits, A-Z lower-cased,
    and of everything beyond ASCII), as UTF-8."""
    data, counts, start = (text or "").encode("utf-8", "surrogatepass"), Counter(), 0
    while start < len(data):
        # A piece ends where no term goes on.
        stop = start + PIECE
        if stop < len(data):
            found = BREAK.search(data, stop)
            stop = found.start() if found else len(data)
        counts.update(TERM.findall(data[start:stop].lower()))
        start = stop
    return counts


def postings(docs: DataFrame, terms: dict[bytes, int]) -> DataFrame:
    """``id, named, n, terms, counts`` of documents with terms: all of them in number, of the
    given ones the places and how often they occur."""
    known = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = known.value.get
        for batch in batches:
            lengths, sizes, flat, counts = [], [], [], []
            for text in batch.column(2):
                found = term_counts(text.as_py())
                lengths.append(found.total())
                before = len(flat)
                for term, count in found.items():
                    at = place(term)
                    if at is not None:
                        flat.append(at)
                        counts.append(count)
                sizes.append(len(flat) - before)
            offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
            yield pa.RecordBatch.from_pydict(
                {
                    "id": batch.column(0), "named": batch.column(1), "n": pa.array(lengths, pa.int64()),
                    "terms": pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int32())),
                    "counts": pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int64())),
                }
            )

    rows = docs.mapInArrow(run, "id long, named boolean, n long, terms array<int>, counts array<long>")
    return saved(rows.where("n > 0"), "postings")


def _flat(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All positions of the ranges, one after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


class Index:
    """Strata of documents with equal ``m``; postings sorted by term, stratum and count."""

    def __init__(self, m: np.ndarray, sizes: np.ndarray, terms: np.ndarray, counts: np.ndarray, n_terms: int):
        strata, self.stratum = np.unique(m, return_inverse=True)
        self.members = np.bincount(self.stratum, minlength=len(strata))
        doc = np.repeat(np.arange(len(m)), sizes)
        order = np.lexsort((counts, self.stratum[doc], terms))
        term, self.doc, tf = terms[order].astype(np.int64), doc[order], counts[order]
        stratum = self.stratum[self.doc]
        # An entry is a run of one term, stratum and count; a cell a run of one term and stratum.
        new_cell = np.ones(len(term), dtype=bool)
        new_cell[1:] = (term[1:] != term[:-1]) | (stratum[1:] != stratum[:-1])
        new_entry = new_cell.copy()
        new_entry[1:] |= tf[1:] != tf[:-1]
        entry, cell = np.flatnonzero(new_entry), np.flatnonzero(new_cell)
        impact = impacts(tf[entry], strata[stratum[entry]])
        self.impact = np.repeat(impact, np.diff(np.append(entry, len(term))))
        self.cell_start, self.cell_size = cell, np.diff(np.append(cell, len(term)))
        self.cell_stratum = stratum[cell]
        # Impacts rise with the count, so a cell's last one bounds it.
        self.cell_bound = self.impact[cell + self.cell_size - 1] if len(cell) else self.impact
        self.term_start = np.searchsorted(term[cell], np.arange(n_terms + 1))

    def search(self, terms: np.ndarray, weights: np.ndarray, floor: int, k: int, key: np.ndarray):
        """The best ``k`` documents of an item and their scores, none below ``floor``."""
        first, last = self.term_start[terms], self.term_start[terms + 1]
        cells = _flat(first, last - first)
        weight = np.repeat(weights, last - first)
        bounds = np.zeros(len(self.members), np.int64)
        np.add.at(bounds, self.cell_stratum[cells], weight * self.cell_bound[cells])
        order = np.argsort(-bounds, kind="stable")
        order = order[bounds[order] > 0]
        reach = np.cumsum(self.members[order])
        docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        total = np.zeros(len(self.stratum), np.int64)
        start, visit = 0, VISIT
        while start < len(order) and bounds[order[start]] >= floor:
            done = reach[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(reach, done + visit, side="right")))
            wave = order[start:stop]
            wave = wave[bounds[wave] >= floor]
            inside = np.zeros(len(self.members), dtype=bool)
            inside[wave] = True
            taken = inside[self.cell_stratum[cells]]
            sizes = self.cell_size[cells[taken]]
            at = _flat(self.cell_start[cells[taken]], sizes)
            np.add.at(total, self.doc[at], self.impact[at] * np.repeat(weight[taken], sizes))
            met = np.flatnonzero(total)
            docs, scores = np.append(docs, met), np.append(scores, total[met])
            total[met] = 0
            best = np.lexsort((key[docs], -scores))[:k]
            docs, scores = docs[best], scores[best]
            if len(docs) == k:
                floor = max(floor, int(scores[-1]))
            start, visit = stop, visit * 2
        return docs, scores


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1_000 * tf + 8 * m)


def _score(items, n_terms: int, docs: int, length: int, k: int):
    """Best documents per task and item; the k-th best of earlier documents is a floor for later ones."""

    def index_of(batches: list[pa.RecordBatch]):
        part = pa.Table.from_batches(batches)
        n = part["n"].to_numpy()
        m = 100 - 75 + (75 * n * docs) // length
        sizes = np.concatenate([np.diff(c.offsets.to_numpy()) for c in part["terms"].chunks])
        terms = np.concatenate([c.flatten().to_numpy() for c in part["terms"].chunks])
        counts = np.concatenate([c.flatten().to_numpy() for c in part["counts"].chunks])
        ids, named = part["id"].to_numpy(), part["named"].to_numpy()
        return Index(m, sizes, terms, counts, n_terms), ids, named

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
        held, size = [], 0
        for batch in batches:
            lengths = batch.column(3).value_lengths().to_numpy() + 1  # a document takes room too
            ends = np.cumsum(lengths)
            start = 0
            while start < len(lengths):
                room = POSTINGS - size + (int(ends[start - 1]) if start else 0)
                stop = max(start + 1, int(np.searchsorted(ends, room, side="right")))
                held.append(batch.slice(start, stop - start))
                size += int(lengths[start:stop].sum())
                if size >= POSTINGS or stop < len(lengths):
                    yield held
                    held, size = [], 0
                start = stop
        if held:
            yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floors: dict[int, list[int]] = {}
        for part in parts(batches):
            index, ids, named = index_of(part)
            # Documents without an id come last among equals.
            key = np.where(named, ids, np.iinfo(np.int64).max)
            rows, found, points = [], [], []
            for row, _, terms, weights in items.value:
                known = floors.setdefault(row, [])
                docs_, scores = index.search(terms, weights, known[-1] if len(known) == k else 1, k, key)
                floors[row] = sorted([*known, *scores.tolist()], reverse=True)[:k]
                rows.append(np.full(len(docs_), row))
                found.append(docs_)
                points.append(scores)
            at = np.concatenate(found).astype(np.int64)
            yield pa.RecordBatch.from_pydict(
                {
                    "item": pa.array(np.concatenate(rows), pa.int64()),
                    "doc_id": pa.array(ids[at], pa.int64(), mask=~named[at]),
                    "score": pa.array(np.concatenate(points), pa.int64()),
                }
            )

    return run


def _search_block(docs: DataFrame, block: list, k: int) -> DataFrame:
    """``item, item_id, doc_id, score``: what every task found for the items of a block."""
    spark = docs.sparkSession
    counted = [(row["row"], row["item_id"], term_counts(row["text"])) for row in block]
    terms = {term: k for k, term in enumerate(sorted(set().union(*[c for _, _, c in counted])))}
    index = postings(docs, terms)
    n_docs, length = index.agg(F.count(F.lit(1)), F.sum("n")).first()
    # One row per term of the block.
    holding = index.select(F.explode("terms").alias("term")).groupBy("term").count()
    df = np.zeros(len(terms), np.int64)
    for row in holding.collect():
        df[row["term"]] = row["count"]
    weight = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(c) + 1))) for c in df]
    items = []
    for row, item_id, counts in counted:
        held = [(terms[t], weight[terms[t]] * times) for t, times in counts.items() if df[terms[t]]]
        if held:
            at, by = zip(*held, strict=True)
            items.append((row, item_id, np.array(at), np.array(by, np.int64)))
    names = spark.createDataFrame([(r, i) for r, i, *_ in items], "item long, item_id long")
    if not items:
        return names.select("item", "item_id", F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score"))
    found = index.mapInArrow(
        _score(spark.sparkContext.broadcast(items), len(terms), n_docs, length, k),
        "item long, doc_id long, score long",
    )
    return found.join(F.broadcast(names), "item").select("item", "item_id", "doc_id", "score")


def search(
    docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", k: int = 10,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents with a score above 0 per item.

    Terms are counted in whole texts. Scores are whole numbers: ``w * ((10^9 tf) div (1000 tf + 8 m))``
    summed over an item's terms, repeats included, with ``w = floor(1000 ln((2N+2)/(2df+1)))`` and
    ``m = 25 + (75 n N) div L``. Equal scores go by document id, null ids last.

    Null and empty texts have no terms: such documents do not count, such items have no rows.
    Documents that repeat are found each; items that repeat, or lack an id, are answered each. Empty
    tables give no rows; other columns are ignored.
    """
    identity = F.col(id_col).cast("long")
    docs = docs.select(
        F.coalesce(identity, F.lit(0).cast("long")).alias("id"), identity.isNotNull().alias("named"),
        F.col(text_col).alias("text"),
    )
    items = saved(
        items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text"))
        .where(F.length("text") > 0)
        .withColumn("row", F.monotonically_increasing_id()),
        "items",
    )
    n_items, size = items.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    blocks = max(groups_of(n_items, ITEMS), groups_of(size or 0, ITEM_BYTES))
    found = None
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == block)
        part = _search_block(docs, own.collect(), k)
        found = part if found is None else found.union(part)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    best = top_per_key(found, ["item"], order, k, F.col("doc_id"))
    return best.select("item_id", "rank", "doc_id", "score")


ORACLE = r"""
with occurrences as (
  select doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from documents
), postings as (
  select doc_id, term, count(*) as tf from occurrences group by doc_id, term
), lengths as (
  select doc_id, sum(tf)::bigint as n from postings group by doc_id
), totals as (
  select count(*) as big_n, sum(n)::bigint as big_l from lengths
), normalised as (
  select doc_id, 100 - 75 + ((75 * n * big_n) // big_l) as m from lengths, totals
), weights as (
  select term, floor(1000 * ln((2 * big_n + 2)::double / (2 * count(*) + 1)::double))::bigint as w
  from postings, totals group by term, big_n
), asked as (
  select item_id, term, count(*) as times from (
    select item_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from benchmark
  ) group by item_id, term
), scored as (
  select item_id, doc_id,
    sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint as score
  from asked join weights using (term) join postings using (term) join normalised using (doc_id)
  group by item_id, doc_id
)
select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank,
  doc_id, score
from scored where score > 0 qualify rank <= 10
"""
