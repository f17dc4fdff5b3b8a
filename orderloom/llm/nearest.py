"""Exact top-k search by inner product, with bounds from segment statistics.

The inner product of two vectors is half of the sum of their squared lengths less their squared
distance, so the largest products are found by bounding distances from below. A segment of a vector
is known by its mean and its deviation; for two vectors, the squared distance is at least the sum
over segments of ``length * ((difference of means)^2 + (difference of deviations)^2)``. Long
segments give a cheap and loose bound, short ones a dearer and closer one: levels go from coarse to
fine, each for what the level before left over, and exact products are worked out for the survivors.

Queries and candidates meet in cells, a block of one with a block of the other, of bounded size. A
query enters its cells with the k-th best product of a bounded number of seeds, which is a floor for
its k-th best of all: it can only cut what is below.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import groups_of, saved, top_per_key

SEGMENTS = (16, 4, 2)
# Rows of a cell: queries, candidates, and candidates that are compared at a time.
QUERIES, CANDIDATES, CHUNK = 4_096, 16_384, 512
# Candidates that a cell has at least, where there are fewer cells than partitions.
LEAST = 512
SEEDS = 1_024
WHOLE = 2.0**53
LARGEST = np.iinfo(np.int64).max


def usable(vector: Column) -> Column:
    """Neither null nor empty, and all components are numbers and finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & fine, F.lit(False))


def whole(vectors: np.ndarray, scale: float) -> np.ndarray:
    """``floor(scale * x)``; what is beyond 64 bits becomes the nearest such number."""
    with np.errstate(over="ignore"):
        down = np.floor(scale * vectors)
    inside = np.abs(down) < 2.0**63
    return np.where(
        inside, np.where(inside, down, 0).astype(np.int64), np.where(down > 0, LARGEST, -LARGEST)
    )


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products of whole vectors, exact; beyond 64 bits the nearest such number."""
    if not len(a) or not len(b):
        return np.zeros((len(a), len(b)), np.int64)
    size = np.abs(a).max().astype(float) * np.abs(b).max().astype(float) * a.shape[1]
    if size < WHOLE:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, -LARGEST, LARGEST).astype(np.int64)


def statistics(vectors: np.ndarray, length: int) -> np.ndarray:
    """Means and deviations of segments, scaled so that the squared difference of two rows is the
    bound on the squared distance."""
    columns = []
    for start in range(0, vectors.shape[1], length):
        part = vectors[:, start : start + length].astype(float)
        mean = part.mean(axis=1)
        deviation = np.sqrt(((part - mean[:, None]) ** 2).mean(axis=1))
        columns += [mean * np.sqrt(part.shape[1]), deviation * np.sqrt(part.shape[1])]
    return np.stack(columns, axis=1)


def _most(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Upper bounds of inner products from two sets of statistics: (|q|^2 + |x|^2 - distance) / 2.

    The statistics of a vector have its length, so the squares cancel and a product is left. What
    rounding may lose is added.
    """
    lengths = np.linalg.norm(a, axis=1)[:, None] * np.linalg.norm(b, axis=1)[None, :]
    return np.maximum(a @ b.T + 1e-9 * (lengths + 1), -LARGEST)


class _Best:
    """The best candidates of each query so far: larger products first, then smaller ids."""

    def __init__(self, floor: np.ndarray, k: int):
        self.floor, self.k = floor.copy(), k
        self.rows = np.zeros((0, 4), np.int64)  # query, score, key of the id, candidate

    def add(self, query: np.ndarray, score: np.ndarray, key: np.ndarray, candidate: np.ndarray):
        rows = np.concatenate([self.rows, np.stack([query, score, key, candidate], axis=1)])
        rows = rows[np.lexsort((rows[:, 3], rows[:, 2], -rows[:, 1], rows[:, 0]))]
        starts = np.searchsorted(rows[:, 0], rows[:, 0], side="left")
        place = np.arange(len(rows)) - starts
        self.rows = rows[place < self.k]
        last = rows[place == self.k - 1]
        self.floor[last[:, 0]] = np.maximum(self.floor[last[:, 0]], last[:, 1])


def search_block(
    queries: np.ndarray, own: np.ndarray, floor: np.ndarray, vectors: np.ndarray, row: np.ndarray,
    key: np.ndarray, k: int, segments: tuple[int, ...] = SEGMENTS,
) -> np.ndarray:
    """The best ``k`` of a block of candidates for each query: query, score, key, candidate.

    ``own`` and ``row`` tell which candidate is the query itself; ``key`` orders ties.
    """
    best = _Best(floor, k)
    asked = [statistics(queries, length) for length in segments]
    for start in range(0, len(vectors), CHUNK):
        part = vectors[start : start + CHUNK]
        left, there = np.arange(len(queries)), np.arange(len(part))
        for level, length in enumerate(segments):
            # Queries and candidates without any pair left are out for the finer levels.
            bound = _most(asked[level][left], statistics(part[there], length))
            alive = bound >= best.floor[left][:, None]
            left, there = left[alive.any(axis=1)], there[alive.any(axis=0)]
        score = products(queries[left], part[there])
        fits = (score >= best.floor[left][:, None]) & (own[left][:, None] != row[start + there][None, :])
        q, c = np.nonzero(fits)
        if len(q):
            at = start + there[c]
            best.add(left[q], score[q, c], key[at], at)
    return best.rows


def _unpack(packed: pd.Series, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(packed), "<i8").reshape(len(packed), size)


def _search(k: int):
    schema = ["query", "query_id", "row", "id", "named", "score"]

    def search(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(candidates):
            return pd.DataFrame(columns=schema).astype("int64").astype({"named": bool})
        size = int(queries["size"].iloc[0])
        row, ids, named = (candidates[c].to_numpy() for c in ("row", "id", "named"))
        # Among equals, candidates without an id come last.
        key = np.where(named, ids, LARGEST)
        order = np.argsort(row)
        found = search_block(
            _unpack(queries["vector"], size), queries["row"].to_numpy(), queries["floor"].to_numpy(),
            _unpack(candidates["vector"], size)[order], row[order], key[order], k,
        )
        q, at = found[:, 0], order[found[:, 3]]
        return pd.DataFrame(
            {
                "query": queries["row"].to_numpy()[q],
                "query_id": queries["id"].to_numpy()[q],
                "row": row[at],
                "id": ids[at],
                "named": named[at],
                "score": found[:, 1],
            }
        )

    return search


def top_k(
    vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20,
    every: int = 20, scale: float = 64,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query the ``k`` largest inner products.

    Components are ``floor(scale * x)``, ``x`` as double. Queries are the rows whose id is divisible
    by ``every``, candidates all rows but the query's own. Equal scores go by id, null ids last, then
    by row. Vectors that are null or empty, or hold null or non-finite components, take no part;
    others meet only those of their length. Repeated rows are candidates each, and where a query's
    row repeats, each is answered. Components and scores beyond 64 bits become the nearest such
    number. A query without candidates, and an empty table, give no rows; other columns are ignored.
    """
    spark = vectors.sparkSession

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            packed = [
                whole(np.asarray(v, dtype=float), scale).astype("<i8").tobytes() for v in frame["vector"]
            ]
            yield frame.assign(size=frame["vector"].map(len), vector=packed)[
                ["id", "named", "size", "vector"]
            ]

    # Ids are kept apart from their absence: a column with nulls would become one of doubles.
    identity = F.col(id_col).cast("long")
    usable_rows = vectors.select(
        F.coalesce(identity, F.lit(0).cast("long")).alias("id"), identity.isNotNull().alias("named"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    ).where(usable(F.col("vector")))
    rows = saved(
        usable_rows.mapInPandas(pack, "id long, named boolean, size int, vector binary")
        .withColumn("row", F.monotonically_increasing_id()),
        "vectors",
    )
    seeds: dict[int, list] = {}
    for seed in rows.limit(SEEDS).collect():
        seeds.setdefault(seed["size"], []).append((seed["row"], bytes(seed["vector"])))

    def with_floor(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for size, part in frame.groupby("size"):
                floor = np.full(len(part), -LARGEST)
                known = seeds.get(size, [])
                if len(known) > k:
                    score = products(
                        _unpack(part["vector"], size), _unpack(pd.Series([v for _, v in known]), size)
                    )
                    own = part["row"].to_numpy()[:, None] == np.array([r for r, _ in known])[None, :]
                    score[own] = -LARGEST
                    floor = np.partition(score, -k, axis=1)[:, -k]
                yield part.assign(floor=floor)[["row", "id", "size", "vector", "floor"]]

    queries = rows.where(F.col("named") & (F.col("id") % every == 0))
    total, asked = rows.count(), queries.count()
    across = int(spark.conf.get("spark.sql.shuffle.partitions"))
    query_blocks = groups_of(asked, QUERIES)
    blocks = max(groups_of(total, CANDIDATES), min(across, groups_of(total, LEAST)))

    def dealt(df: DataFrame, own: str, n: int, other: str, of: int) -> DataFrame:
        """Each row to its own block, once for every block of the other side."""
        every_other = F.explode(F.sequence(F.lit(0), F.lit(of - 1)))
        return df.withColumn(own, F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")).withColumn(other, every_other)

    cell = ["size", "query_block", "block"]
    left = dealt(
        queries.mapInPandas(with_floor, "row long, id long, size int, vector binary, floor long"),
        "query_block", query_blocks, "block", blocks,
    )
    right = dealt(rows, "block", blocks, "query_block", query_blocks)
    found = (
        left.groupBy(*cell).cogroup(right.groupBy(*cell))
        .applyInPandas(
            _search(k), "query long, query_id long, row long, id long, named boolean, score long"
        )
        .withColumn("vec_id", F.when(F.col("named"), F.col("id")))
    )
    order = [F.desc("score"), F.asc_nulls_last("vec_id"), F.asc("row")]
    return top_per_key(found, ["query"], order, k, F.col("row")).select("query_id", "rank", "vec_id", "score")


ORACLE = """
with rows as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as v from embeddings
  where embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
  from rows q join rows c on q.vec_id <> c.vec_id and len(q.v) = len(c.v)
  where q.vec_id % 20 = 0
)
select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank,
  vec_id, score
from scored qualify rank <= 20
"""
