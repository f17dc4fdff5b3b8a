"""Near-duplicate vectors by a subspace pigeonhole join.

For unit vectors cosine >= c means a squared distance of at most 2 - 2c. A fixed random rotation
spreads it evenly over the coordinates; these are cut into blocks, and each block gets its share of
the budget. If two vectors are near, then at least one block is within its share. So every block is
joined by range alone (a grid over its first coordinates, whose cells are as wide as the range) and
the union of what is found is verified.

- **Pairs are no rows.** Rotated coordinates travel as whole numbers, so every task works out the
  same distances. A pair belongs to the first block that finds it, and is verified there: what a
  task returns is how many links each of its vectors has, and a forest that joins what they join.
  Only pairs whose cosine the whole numbers cannot tell from the threshold (about one in a thousand
  near it) leave as rows, and get their exact cosine in double precision.
- **Copies.** Equal vectors are one node with a count.
- **Hot cells.** Cells with many rows are dealt out as pairs of parts, each part pair a group of its
  own, so no cell is gathered whole.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import checked_broadcast, components, saved
from orderloom.llm.hashing import mix

WIDTH = 8
# A grid has so many coordinates that a cell of an even spread has about so many members.
MEMBERS, CELLS_PER_AXIS = 1_024, 7
BROADCAST_ROWS = 1_000_000
# Begins the second half of a vector's hash.
TWIN = 0x5DEECE66D
# Rows of a cell above which it is split into parts of this size.
PART = 8_192
# Coordinates are whole numbers of this unit: sums of their squares are exact in doubles.
SCALE = 1 << 22
# Coordinates of pairs whose distances are worked out at once.
AT_ONCE = 1 << 21


def rotation(size: int) -> np.ndarray:
    """A random orthogonal matrix, the same everywhere."""
    q, r = np.linalg.qr(np.random.default_rng(size).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that squares neither overflow nor vanish."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def usable(vector: Column) -> Column:
    """Neither null nor empty nor zero, and all components are numbers and finite."""
    fine = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )
    return F.coalesce(
        (F.size(vector) > 0) & fine & F.exists(vector, lambda x: x != 0), F.lit(False)
    )


def _shares(size: int, budget: float) -> list[tuple[int, int]]:
    """Start of every block and the whole number that its distances may reach.

    Rounding moves a difference by at most one unit per coordinate.
    """
    out = []
    for start in range(0, size, WIDTH):
        width = min(WIDTH, size - start)
        reach = math.sqrt(max(0.0, budget) * width / size) * (1 + 1e-9)
        out.append((start, math.ceil(reach * SCALE + math.sqrt(width)) + 1))
    return out


def _spread(budget: float, axes: int):
    """Rows for the grid: each vector at home in its cell, and a visitor of half of its neighbours."""

    def spread(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sizes = frame["vector"].map(len)
            for size in sorted(sizes.unique()):
                part = frame[sizes == size]
                turned = unit(np.stack(part["vector"].to_numpy()).astype(float)) @ rotation(size)
                whole = np.rint(turned * SCALE).astype("<i4")
                packed = [row.tobytes() for row in whole]
                group = mix(part["group"].to_numpy().astype(np.int64).view(np.uint64))
                for block, (start, reach) in enumerate(_shares(size, budget)):
                    own = whole[:, start : start + WIDTH].astype(np.int64)
                    cells = own[:, : min(axes, own.shape[1])] // (reach + 1)
                    for step in itertools.product((-1, 0, 1), repeat=cells.shape[1]):
                        if step < (0,) * len(step):
                            continue
                        key = group + np.uint64(size * 65_537 + block)
                        for axis, by in enumerate(step):
                            key = mix(key + (cells[:, axis] + by).view(np.uint64))
                        yield pd.DataFrame(
                            {
                                "cell": key.view(np.int64),
                                "group": part["group"].to_numpy(),
                                "block": block,
                                "node": part["node"].to_numpy(),
                                "copies": part["copies"].to_numpy(),
                                "home": not any(step),
                                "place": packed,
                            }
                        )

    return spread


def _owned(places: np.ndarray, a: np.ndarray, b: np.ndarray, shares: list, block: int) -> np.ndarray:
    """Which pairs, near in a block, are near in no block before it."""
    out = np.ones(len(a), dtype=bool)
    starts = [start for start, _ in shares[:block]]
    if not starts:
        return out
    most = np.array([float(reach) ** 2 for _, reach in shares[:block]])
    end = starts[-1] + WIDTH
    step = max(1, AT_ONCE // places.shape[1])
    for at in range(0, len(a), step):
        gap = places[a[at : at + step], :end] - places[b[at : at + step], :end]
        out[at : at + step] = (np.add.reduceat(gap * gap, starts, axis=1) > most).all(axis=1)
    return out


def _cosines(places: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.empty(len(a))
    step = max(1, AT_ONCE // places.shape[1])
    for at in range(0, len(a), step):
        products = places[a[at : at + step]] * places[b[at : at + step]]
        out[at : at + step] = products.sum(axis=1) / float(SCALE) ** 2
    return out


def _lowest(low: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The lowest row that each row reaches by pairs, and by those that ``low`` comes from."""
    while True:
        least = np.minimum(low[a], low[b])
        now = low.copy()
        np.minimum.at(now, low[a], least)
        np.minimum.at(now, low[b], least)
        now = now[now]
        if (now == low).all():
            return low
        low = now


def _tile(tile: pd.DataFrame, budget: float) -> list[pd.DataFrame]:
    """What a cell, or two of its parts, finds: link counts, forest, and pairs too close to call."""
    places = np.frombuffer(b"".join(tile["place"]), "<i4").reshape(len(tile), -1).astype(float)
    size, block = places.shape[1], int(tile["block"].iloc[0])
    shares = _shares(size, budget)
    start, reach = shares[block]
    nodes, copies = tile["node"].to_numpy(), tile["copies"].to_numpy()
    home, own = tile["home"].to_numpy(dtype=bool), tile["own"].to_numpy()
    i, j = int(tile["i"].iloc[0]), int(tile["j"].iloc[0])
    first, second = np.flatnonzero(own == i), np.flatnonzero(own == j)
    if not len(first) or not len(second):
        return []
    spots = places[:, start : start + WIDTH]
    squares = (spots * spots).sum(axis=1)
    error = 1.01 * math.sqrt(size) / SCALE + 1e-9
    least, out = 1 - budget / 2, []
    linked, low = np.zeros(len(tile)), np.arange(len(tile))
    stripe = max(1, AT_ONCE // len(second))
    for at in range(0, len(first), stripe):
        some = first[at : at + stripe]
        # All whole numbers: the same here and wherever the pair is looked at.
        apart = squares[some][:, None] + squares[second] - 2 * (spots[some] @ spots[second].T)
        near = np.flatnonzero((apart <= float(reach) ** 2).ravel())
        a, b = some[near // len(second)], second[near % len(second)]
        fits = (home[a] | home[b]) & (nodes[a] != nodes[b])
        if i == j:
            fits &= a < b
        a, b = a[fits], b[fits]
        kept = _owned(places, a, b, shares, block)
        a, b = a[kept], b[kept]
        cosine = _cosines(places, a, b)
        open_ = np.abs(cosine - least) < error
        out.append(pd.DataFrame({"a": nodes[a[open_]], "b": nodes[b[open_]], "linked": -1}))
        sure = cosine >= least + error
        a, b = a[sure], b[sure]
        linked += np.bincount(a, copies[b], len(tile)) + np.bincount(b, copies[a], len(tile))
        low = _lowest(low, a, b)
    some = np.flatnonzero(linked)
    counted = {"a": nodes[some], "b": nodes[low[some]], "linked": linked[some].astype(np.int64)}
    return [*out, pd.DataFrame(counted)]


def _compare(budget: float):
    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"a": [], "b": [], "linked": []}).astype("int64")]
        frame = frame.assign(bytes=frame["place"].map(len))
        # Where hashes agree by chance, cells of other blocks, labels or lengths are kept apart.
        for _, tile in frame.groupby(["cell", "i", "j", "group", "block", "bytes"]):
            if len(tile) > 1:
                out += _tile(tile, budget)
        return pd.concat(out, ignore_index=True).astype("int64")

    return compare


def found(nodes: DataFrame, cosine: float) -> DataFrame:
    """What the tiles find: ``a`` has ``linked`` links there and hangs together with ``b``; where
    ``linked`` is -1, the pair needs its exact cosine."""
    budget = 2 - 2 * cosine
    most = nodes.groupBy("group").count().agg(F.max("count")).first()[0] or 1
    axes = min(WIDTH, max(1, math.ceil(math.log(max(1, most / MEMBERS), CELLS_PER_AXIS))))
    rows = nodes.select("node", "group", "copies", "vector").mapInPandas(
        _spread(budget, axes),
        "cell long, group long, block int, node long, copies long, home boolean, place binary",
    )
    large = saved(
        rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > PART)
        .select("cell", F.ceil(F.col("n") / PART).alias("parts")),
        "cells",
    )
    large = checked_broadcast(large, large.count(), BROADCAST_ROWS)
    dealt = (
        rows.join(large, "cell", "left")
        .withColumn("parts", F.coalesce("parts", F.lit(1)))
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        .withColumn("i", F.least("own", "other"))
        .withColumn("j", F.greatest("own", "other"))
        # One column, so that the tiles of a cell are dealt apart.
        .withColumn("tile", F.xxhash64("cell", "i", "j"))
        .drop("other", "parts")
    )
    return dealt.groupBy("tile").applyInPandas(_compare(budget), "a long, b long, linked long")


def _exact(cosine: float):
    def exact(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if not len(frame):
                continue
            same = (frame["of_a"].map(len) == frame["of_b"].map(len)) & (
                frame["group_a"] == frame["group_b"]
            )
            frame = frame[same]
            for _, part in frame.groupby(frame["of_a"].map(len)):
                a = np.stack(part["of_a"].to_numpy()).astype(float)
                b = np.stack(part["of_b"].to_numpy()).astype(float)
                a = a / np.abs(a).max(axis=1, keepdims=True)
                b = b / np.abs(b).max(axis=1, keepdims=True)
                dot = (a * b).sum(axis=1)
                near = dot / (np.linalg.norm(a, axis=1) * np.linalg.norm(b, axis=1)) >= cosine
                yield part.loc[near, ["a", "b"]]

    return exact


def near_duplicates(
    vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding",
    label_col: str = "label", cosine: float = 0.98,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row.

    Vectors link when their labels are equal and not null, their lengths agree and their cosine in
    double precision reaches ``cosine``. Vectors that are null, empty or zero, or hold null or
    non-finite components, link with nothing. ``n_links`` counts the other rows linked directly,
    repeated rows too; ``component_id`` is the smallest id reachable, the own one included; ``kept``
    says whether it is the own one. Rows without an id link like others but give no component their
    id; they are not kept. An empty table gives no rows; other columns are ignored. Equal vectors
    are known by a 128-bit hash (among m different ones a mix-up has a chance of m^2 / 2^129).
    """
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(label_col).alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    )
    # Zeros of either sign are the same number and must hash alike.
    plain = F.transform("vector", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))
    fine = F.col("label").isNotNull() & usable(F.col("vector"))
    rows = rows.withColumn("key", F.when(fine, F.xxhash64("label", plain))).withColumn(
        "twin", F.when(fine, F.xxhash64(F.lit(TWIN), "label", plain))
    )
    nodes = saved(
        rows.where("key is not null")
        .groupBy("key", "twin", F.xxhash64("label").alias("group"), "vector")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first"))
        .dropDuplicates(["key", "twin"])
        .withColumn("node", F.monotonically_increasing_id()),
        "vectors",
    )
    tiles = saved(found(nodes, cosine), "tiles")
    pairs = tiles.where("linked < 0").select("a", "b")

    def with_vector(df: DataFrame, column: str, end: str) -> DataFrame:
        return df.join(
            nodes.select(
                F.col("node").alias(column), F.col("vector").alias(f"of_{end}"),
                F.col("group").alias(f"group_{end}"),
            ),
            column,
        )

    links = saved(
        with_vector(with_vector(pairs, "a", "a"), "b", "b").mapInPandas(
            _exact(cosine), "a long, b long"
        ),
        "vector-links",
    )
    both = links.union(links.select("b", "a")).toDF("node", "other")
    copies = nodes.select(F.col("node").alias("other"), "copies")
    late = both.join(copies, "other").select("node", F.col("copies").alias("linked"))
    sure = tiles.where("linked >= 0")
    linked = sure.select(F.col("a").alias("node"), "linked").union(late)
    linked = linked.groupBy("node").agg(F.sum("linked").alias("linked"))
    groups = components(sure.select("a", "b").union(links), "a", "b")
    named = (
        nodes.select("node", "key", "twin", "copies", "first")
        .join(linked, "node", "left")
        .join(groups, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    least = named.groupBy("root").agg(F.min("first").alias("least"))
    named = named.join(least, "root").select(
        "node", "key", "twin", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), "least"
    )
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("least"))
    return rows.select("vec_id", "key", "twin").join(named, ["key", "twin"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
