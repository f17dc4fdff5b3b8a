"""Mix sources to target weights by subset-sum budget fitting."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from orderloom.llm.common import SPACE, fresh, let, saved

# The knapsack's table covers a remaining budget of so many words at first, and more if that leaves a gap.
TABLE_WORDS = 1 << 15
# Documents of one source and length are ranked in so many parts, so no length is one task's work.
SALTS = 64


def n_words(text):
    """Words without ASCII white space; 0 for null."""

    def count(bare):
        ends = F.when(F.substring(bare, -1, 1).rlike(SPACE), 1).otherwise(0)
        words = F.size(F.split(bare, SPACE, -1)) - ends
        return F.when(F.length(bare) > 0, words).otherwise(0).cast("long")

    return let(F.regexp_replace(F.coalesce(text, F.lit("")), f"^{SPACE}", ""), count)


def source_targets(words: DataFrame, key: str, weights: Sequence[int], most: int) -> DataFrame:
    """What the mix takes from each source: ``key, source_size, target, copies, budget``.

    ``words`` has ``key`` (empty for null) and ``words`` of every source. Sources by code point, null
    last, share all words by the weights, repeated in turn. A target stops at ``most`` times its
    source's size; the excess is shared again by weight among the others until no target is above. A
    source without words gets 0. A target is so many whole copies of its source, and a budget of words.

    Sources are ranked by a sort and shared out by sums; these alone reach the driver, and the number
    of rows per sorted partition.
    """
    spark = words.sparkSession
    place, part, offset = fresh(words, "place", "part", "offset")
    rows = saved(
        words.orderBy(F.col(key) == "", key).withColumn(place, F.monotonically_increasing_id()), "sources"
    )
    # An id is the partition and the place in it.
    rows = rows.withColumn(part, F.shiftright(place, 33)).withColumn(place, F.col(place).bitwiseAND(2**33 - 1))
    before, offsets = 0, []
    for row in rows.groupBy(part).count().orderBy(part).collect():
        offsets.append((row[0], before))
        before += row["count"]
    offsets = spark.createDataFrame(offsets, f"`{part}` long, `{offset}` long")
    turn = ((F.col(place) + F.col(offset)) % len(weights) + 1).cast("int")
    rows = rows.join(F.broadcast(offsets), part).select(
        key, F.col("words").alias("source_size"),
        F.element_at(F.array(*[F.lit(w) for w in weights]), turn).cast("decimal(19,0)").alias("weight"),
    )
    rows = saved(rows, "weights")
    size = F.col("source_size").cast("decimal(19,0)")

    def stops(left: int, open_weight: int) -> Column:
        """Whether a source's share would exceed its limit, in whole numbers."""
        return size * most * F.lit(Decimal(open_weight)) < F.lit(Decimal(left)) * F.col("weight")

    total, every_weight = (int(v or 0) for v in rows.agg(F.sum("source_size"), F.sum("weight")).first())
    left, open_weight = total, every_weight
    while open_weight:
        # The share per weight only grows, so what has stopped stays stopped.
        taken, stopped = rows.where(stops(left, open_weight)).agg(F.sum(size), F.sum("weight")).first()
        now = (total - most * int(taken or 0), every_weight - int(stopped or 0))
        if now == (left, open_weight):
            break
        left, open_weight = now
    share = F.lit(Decimal(left)) * F.col("weight")
    whole = F.lit(Decimal(max(open_weight, 1)))
    is_stopped = stops(left, open_weight) if open_weight else F.lit(True)
    fits = [(share >= F.lit(Decimal(k)) * size * whole).cast("int") for k in range(1, most + 1)]
    copies = F.when(size == 0, 0).when(is_stopped, most).otherwise(sum(fits[1:], fits[0]))
    rows = rows.withColumn("copies", copies.cast("long"))
    # Halves of the words that are left go to the even number.
    rest = share - (F.col("copies").cast("decimal(19,0)") * size).cast("decimal(28,0)") * whole
    down, twice = (rest - rest % whole) / whole, rest % whole * 2
    up = (twice > whole) | ((twice == whole) & (down % 2 == 1))
    return rows.select(
        key, "source_size",
        F.when(is_stopped, (size * most).cast("double"))
        .otherwise(share.cast("double") / whole.cast("double")).alias("target"),
        "copies",
        F.when(is_stopped | (size == 0), 0).otherwise(down + up.cast("int")).cast("long").alias("budget"),
    )


def fit(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length, at most ``counts``, add up closest below ``budget``.

    First every length gives its proportional share, which stays; no choice of the other documents
    comes closer. To find one, the longest lengths fill up until the remaining budget fits the
    table and a bounded knapsack settles that rest. Where this leaves a gap, the table grows until
    there is none or the knapsack covers all that the shares left.
    """
    lengths = lengths.astype(object)
    counts = counts.astype(object)
    total = int((lengths * counts).sum())
    budget = min(budget, total)
    if total == 0 or budget <= 0:
        return np.zeros(len(lengths), dtype=np.int64)
    taken = counts * budget // total
    rest, left = budget - int((lengths * taken).sum()), counts - taken
    order = np.argsort(-lengths.astype(np.int64), kind="stable")
    order = [int(i) for i in order if left[i] and 0 < lengths[i] <= rest]
    # Sums are multiples of the lengths' common divisor, so tables count in it.
    unit = math.gcd(*(int(lengths[i]) for i in order)) or 1
    steps, room, table = [int(x) // unit for x in lengths], rest // unit, TABLE_WORDS
    while order and room:
        more, gap = _fill(steps, left, room, order, table)
        if not gap or table >= room:
            return (taken + more).astype(np.int64)
        table *= 4
    return taken.astype(np.int64)


def _fill(
    steps: list[int], left: np.ndarray, rest: int, order: list[int], table: int
) -> tuple[np.ndarray, int]:
    """How many of each length, at most ``left``, fill ``rest``, and what they leave of it.

    Exact for a rest within the table. ``via`` keeps the length that first reached each sum, from
    longer to shorter lengths, so a walk back never repeats one more often than it is there.
    """
    taken = np.zeros(len(steps), dtype=object)
    for i in order:
        if rest <= table:
            break
        taken[i] = min(left[i], rest // steps[i])
        rest -= taken[i] * steps[i]
    if not 0 < rest <= table:
        return taken, rest
    via = np.full(rest + 1, -1, dtype=np.int32)
    reached = np.zeros(rest + 1, dtype=bool)
    reached[0] = True
    for i in order:
        step, more = steps[i], int(left[i] - taken[i])
        if step > rest or not more:
            continue
        last = reached
        for _ in range(min(more, rest // step)):
            new = np.zeros_like(reached)
            new[step:] = last[:-step]
            new &= ~reached
            if not new.any():
                break
            via[new] = i
            reached |= new
            last = new
        if reached[rest]:
            break
    at = best = int(np.flatnonzero(reached)[-1])
    while at:
        taken[via[at]] += 1
        at -= steps[via[at]]
    return taken, rest - best


def mix(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = (1, 2, 3),
    most: int = 3,
    seed: int = 7,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Words of every document that a mix of the sources takes.

    Returns the id, ``carry`` columns and ``size`` (words), ``source_size``, ``target`` (double, of
    the document's source), ``taken`` (words taken, repeats counted), long, and ``times``: how often
    the document itself is taken.

    A source takes all its documents as often as its target allows in full; documents chosen by
    ``fit`` on the counts per exact length are taken once more. Which documents of a length are
    chosen depends on a seeded hash of the id, so runs agree. No document is taken more than
    ``most`` times. Empty and null texts have size 0 and give no words; null sources form one
    source, the last; null ids and repeated rows are documents like others (of rows that agree in
    id, source and size, any may be chosen); an empty table gives an empty result. Given columns
    named like the results are replaced.

    Targets are worked out by sums over the sources, of which there may be any number. A source's counts
    per length go to one task: as many rows as it has different lengths, not documents.
    """
    results = ("size", "source_size", "target", "taken", "times")
    carry = [c for c in carry if c not in (*results, id_col)]
    key, salt, rank_hash, count, before, at = fresh(
        docs, "source", "salt", "hash", "count", "before", "rank"
    )
    sized = docs.select(
        F.col(id_col),
        *carry,
        n_words(F.col(text_col)).alias("size"),
        F.coalesce(F.concat(F.lit("="), F.col(source_col)), F.lit("")).alias(key),
        # Rows without an id are told apart by their text.
        F.when(F.col(id_col).isNotNull(), F.xxhash64(F.col(id_col), F.lit(seed)))
        .otherwise(F.xxhash64(F.col(text_col), F.lit(seed))).alias(rank_hash),
    ).withColumn(salt, F.pmod(rank_hash, F.lit(SALTS)))
    # Texts are read once, or once more where columns are carried along.
    if not carry:
        sized = saved(sized, "sizes")
    counts = saved(sized.groupBy(key, "size", salt).agg(F.count(F.lit(1)).alias(count)), "counts")
    per_source = counts.groupBy(key).agg(F.sum(F.col("size") * F.col(count)).alias("words"))
    summary = saved(source_targets(per_source, key, weights, most), "targets")

    def choose(group: tuple, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(frames))
        chosen = fit(frame["size"].to_numpy(), frame["n"].to_numpy(), int(frame["budget"].iloc[0]))
        yield pd.DataFrame({"source": group[0], "size": frame["size"], "chosen": chosen})

    per_length = counts.groupBy(key, "size").agg(F.sum(count).alias("n"))
    chosen = (
        per_length.join(summary, key)
        .groupBy(key)
        .applyInPandas(choose, T.StructType.fromDDL("source string, size long, chosen long"))
        .withColumnRenamed("source", key)
    )
    quotas = counts.withColumn(
        before,
        F.sum(count).over(
            Window.partitionBy(key, "size").orderBy(salt).rowsBetween(Window.unboundedPreceding, -1)
        ),
    ).join(chosen, [key, "size"])
    quotas = quotas.join(summary, key).select(
        key, "size", salt, F.coalesce(before, F.lit(0)).alias(before), "chosen", "source_size",
        "target", "copies",
    )
    ranked = sized.withColumn(
        at, F.row_number().over(Window.partitionBy(key, "size", salt).orderBy(rank_hash, id_col))
    )
    times = F.col("copies") + (F.col(at) + F.col(before) <= F.col("chosen")).cast("long")
    return ranked.join(quotas, [key, "size", salt]).select(
        id_col, *carry, "size", "source_size", "target", (F.col("size") * times).alias("taken"),
        times.alias("times"),
    )
