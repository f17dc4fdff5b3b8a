"""Helpers of the training-data operators."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderloom.session import scratch_dir

# Words of the contracts: maximal runs without ASCII white space (Java and Python syntax alike).
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
# A key's rows are ranked in so many parts first.
PARTS = 32
# Links that one task may join; rounds go on while there are more.
FEW_LINKS = 1 << 18


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read again: a cut in the lineage that lost
    executors do not undo, and that later jobs read instead of computing it once more."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(id_col: str, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text has that remainder; a null id is never held out."""
    value = F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(modulus))
    return F.coalesce(value == remainder, F.lit(False))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once per row, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def checked_broadcast(df: DataFrame, rows: int, limit: int) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows are within the limit."""
    return F.broadcast(df) if rows <= limit else df


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All nodes of the links ``a, b``, and the smallest node that each can reach."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = place[: len(a)], place[len(a) :]
    root = np.arange(len(nodes))
    while True:
        own, other = root[x], root[y]
        apart = own != other
        if not apart.any():
            return nodes, nodes[root]
        x, y, own, other = x[apart], y[apart], own[apart], other[apart]
        np.minimum.at(root, np.maximum(own, other), np.minimum(own, other))
        while (root != (above := root[root])).any():
            root = above


def _joined(links: DataFrame) -> DataFrame:
    """``node, root`` of at most FEW_LINKS links, which fit into one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends = [(batch.column(0).to_numpy(), batch.column(1).to_numpy()) for batch in batches]
        if ends:
            nodes, roots = stars(*[np.concatenate(end) for end in zip(*ends, strict=True)])
            yield pa.RecordBatch.from_pydict(
                {"node": pa.array(nodes, pa.int64()), "root": pa.array(roots, pa.int64())}
            )

    return saved(links.coalesce(1).mapInArrow(run, "node long, root long"), "components")


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Connected components of undirected edges: ``node``, ``root`` (the smallest node reachable).

    Alternates large-star and small-star steps (Kiveris et al. 2014): each round every node links
    its neighbours to the smallest one seen, until nothing changes. A hub's links stay one row per
    neighbour, so no group is gathered: minima are aggregates and joins that Spark can split. Each
    round is written to the scratch folder. Once FEW_LINKS or fewer are left, a number that does not
    grow with the input, numpy ends the work in one pass, which saves rounds over next to no rows.
    Ends are whole numbers; null ends and loops give no rows.
    """
    a, b = F.col(a).cast("long"), F.col(b).cast("long")
    low, high = F.least(a, b), F.greatest(a, b)
    links = saved(
        edges.where(a.isNotNull() & b.isNotNull() & (a != b))
        .select(high.alias("u"), low.alias("v"))
        .distinct(),
        "links",
    )
    state, left = None, links.count()
    while left > FEW_LINKS:
        # Large star: larger neighbours of a node go to the smallest of its neighbourhood.
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(least, "u").where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        # Small star: a node and its smaller neighbours go to the smallest of them.
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(down, "u")
            .select(
                F.explode(
                    F.array(
                        F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                        F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                    )
                ).alias("e")
            )
            .select("e.u", "e.v")
            .where(F.col("u") != F.col("v"))
            .distinct()
        )
        links = saved(small, "links")
        now = links.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if tuple(now) == state:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                links.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
            )
        state, left = tuple(now), now[0]
    return _joined(links)


def numbered(df: DataFrame, id_col: str) -> tuple[DataFrame, str]:
    """``df`` and a column that tells its rows apart.

    That is the id, if no row lacks one and none repeats. Otherwise a row number is added to a copy
    in the scratch folder, so that it stays the same however often it is read.
    """
    rows, ids = df.agg(F.count(F.lit(1)), F.count_distinct(id_col)).first()
    if rows == ids:
        return df, id_col
    (number,) = fresh(df, "row")
    return saved(df.withColumn(number, F.monotonically_increasing_id()), "numbered"), number


def groups_of(total: int, each: int) -> int:
    return max(1, math.ceil(total / each))


def named(column: str) -> Column:
    """A column by its whole name, which may hold dots and quotes."""
    return F.col("`" + column.replace("`", "``") + "`")


def columns_of(df: DataFrame) -> list[Column]:
    return [named(c) for c in df.columns]


def fresh(df: DataFrame, *stems: str) -> list[str]:
    """Names that no column of ``df`` has."""
    taken, out = {c.lower() for c in df.columns}, []
    for stem in stems:
        name = f"_{stem}"
        while name.lower() in taken:
            name = f"_{stem}_{uuid.uuid4().hex[:8]}"
        out.append(name)
    return out


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], limit: int, spread: Column) -> DataFrame:
    """The first ``limit`` rows of every key with their ``rank``.

    Keys are first dealt into parts by ``spread``, so a key with many rows is not one task's work.
    """
    (part,) = fresh(df, "part")

    def first(rows: DataFrame, by: list[str], out: str) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        return rows.withColumn(out, place).where(F.col(out) <= limit)

    parts = first(df.withColumn(part, F.pmod(F.xxhash64(spread), F.lit(PARTS))), [*keys, part], "rank")
    return first(parts.drop("rank"), keys, "rank").drop(part)
