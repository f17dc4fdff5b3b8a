"""N-gram Jaccard join with adaptive multi-match prefixes.

Shingles are ordered from rare to frequent. If two sets reach the threshold, their prefixes of
``n - ceil(t n) + l`` shingles share at least ``l`` of them. ``l`` grows with ``n``: a longer prefix
costs a few rows, but asks for more shared shingles. A pair must share the smaller of both numbers;
then the whole sets are compared.

- **Order.** A table of hashed counts of bounded size, filled from all documents, estimates how many
  documents have a shingle. It only sets the order, so its errors cost time, never links.
- **Copies.** Equal sets are one node, known by a 64-bit hash of the set (among m different sets a
  mix-up has a chance of m^2 / 2^65), so copies give neither candidates nor pairs.
- **Small buckets.** Prefix rows with the same shingle pair up. What a pair may share in large
  buckets (no more than either set has there) counts as shared, so one small bucket in common
  is enough to be found here.
- **Large buckets.** What is left shares all its ``l`` shingles in large buckets. Only sets with so
  many of them stay, without their ``l - 1`` largest buckets: few do that met by chance. Members are
  compared with one of them first, then with members of other components, in pairs of blocks.
- **Candidates** pass a bound before they count: sets are hashed into about a bit per shingle, and
  two sets differ in at least as many shingles as their bits do. So chance meetings link nothing.
- **Clusters** of connected candidates: each set travels to its cluster once. A large cluster is
  compared with one centre first; what that links needs no comparison among itself, the others meet
  all members in blocks. Clusters and blocks return a spanning forest of their links. No bucket or
  cluster is gathered whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import (
    checked_broadcast,
    columns_of,
    components,
    groups_of,
    numbered,
    saved,
    stars,
)
from orderloom.llm.hashing import mix, shingle_hashes, word_hashes

# Hashed counts: slices of counts, each summed up by one group.
SLICES, SLICE = 64, 1 << 14
# Buckets above this size do not pair up; members of a block of whole sets, and of one of bits.
BUCKET, BLOCK, BITS_BLOCK = 32, 256, 1024
# Shared shingles that a prefix asks for: so many, and one more for so many shingles of the set.
MATCHES, MATCHES_EACH = 7, 128
PIECE = 1 << 20
BROADCAST_ROWS = 1_000_000


def shingle_sets(texts: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """Index and sorted distinct shingle hashes of every text; shorter texts have one shingle.

    Texts are taken from the batch a piece at a time, so little of it is in memory twice.
    """
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    start = 0
    while start < len(texts):
        reach = PIECE + (int(ends[start - 1]) if start else 0)
        stop = max(start + 1, int(np.searchsorted(ends, reach, side="right")))
        words, offsets = word_hashes(texts.slice(start, stop - start).to_pylist())
        every = shingle_hashes(words, width) if len(words) >= width else words[:0]
        for k in range(stop - start):
            a, b = offsets[k], offsets[k + 1]
            if b - a >= width:
                yield start + k, np.unique(every[a : b - width + 1])
            else:
                yield start + k, np.unique(shingle_hashes(words[a:b], width))
        start = stop


def _bucket(shingles: np.ndarray) -> np.ndarray:
    return (shingles & np.uint64(SLICES * SLICE - 1)).astype(np.int64)


def frequency_table(docs: DataFrame, text_col: str, width: int) -> np.ndarray:
    """How many documents have a shingle of each hash bucket: a million counts, whatever the input."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(SLICES * SLICE, dtype=np.uint32)
        for batch in batches:
            for _, shingles in shingle_sets(batch.column(0), width):
                np.add.at(table, _bucket(shingles), 1)
        if table.any():
            parts = [part.tobytes() for part in table.reshape(SLICES, SLICE)]
            yield pa.RecordBatch.from_pydict(
                {"slice": pa.array(range(SLICES), pa.int32()), "counts": pa.array(parts)}
            )

    def add(key: tuple, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(SLICE, dtype=np.int64)
        for frame in frames:
            for counts in frame["counts"]:
                total += np.frombuffer(counts, "<u4")
        yield pd.DataFrame({"slice": [key[0]], "counts": [total.astype("<u8").tobytes()]})

    parts = docs.select(text_col).mapInArrow(count, "slice int, counts binary")
    rows = parts.groupBy("slice").applyInPandas(add, "slice int, counts binary")
    table = np.zeros((SLICES, SLICE), dtype=np.int64)
    for row in rows.collect():  # at most SLICES rows
        table[row["slice"]] = np.frombuffer(row["counts"], "<u8")
    table = table.reshape(-1)
    return np.maximum(table - int(table.mean()), 1).astype(np.uint32)


def prefix(shingles: np.ndarray, df: np.ndarray, num: int, den: int) -> tuple[int, np.ndarray]:
    """The number of matches a set asks for, and its prefix for that number.

    Shingles are sorted; ``df`` has their estimated frequencies.
    """
    n = len(shingles)
    need = -(-n * num // den)
    matches = min(need, MATCHES + n // MATCHES_EACH)
    order = np.argsort(df, kind="stable")  # equal frequencies: by shingle
    return matches, shingles[order[: n - need + matches]]


def _need(n: Column, num: int, den: int) -> Column:
    """Shingles that a set of ``n`` shares with every set it links to; none of those is smaller."""
    return F.ceil(n * num / F.lit(den))


def _matches(n: Column, num: int, den: int) -> Column:
    """The number of matches that a set of ``n`` shingles asks for, as in ``prefix``."""
    return F.least(_need(n, num, den), MATCHES + F.floor(n / MATCHES_EACH))


def parity_bits(shingles: np.ndarray) -> bytes:
    """Whether an odd number of shingles falls on each of about as many bits as there are shingles.

    The number of bits is a power of two, at least 64. Each shingle that only one of two sets has
    changes one bit, so at least as many shingles differ as bits do.
    """
    width = 1 << max(6, (len(shingles) - 1).bit_length())
    spots = (shingles & np.uint64(width - 1)).astype(np.int64)
    odd = (np.bincount(spots, minlength=width) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").tobytes()


def _set_id(shingles: np.ndarray) -> int | None:
    if not len(shingles):
        return None
    total = mix(shingles).sum(dtype=np.uint64) + np.uint64(len(shingles))
    return int(mix(np.array([total], dtype=np.uint64)).view(np.int64)[0])


def describe(docs: DataFrame, text_col: str, width: int, num: int, den: int) -> DataFrame:
    """``doc_id, n_shingles, set_id, bits, prefix`` per document (``doc_id`` is the first column)."""
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(frequency_table(docs, text_col, width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = table.value
        for batch in batches:
            sizes, sets, bits, prefixes = [], [], [], []
            for _, shingles in shingle_sets(batch.column(1), width):
                sizes.append(len(shingles))
                sets.append(_set_id(shingles))
                bits.append(parity_bits(shingles))
                first = prefix(shingles, counts[_bucket(shingles)], num, den)[1]
                prefixes.append(first.view(np.int64))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column(0),
                    "n_shingles": pa.array(sizes, pa.int64()),
                    "set_id": pa.array(sets, pa.int64()),
                    "bits": pa.array(bits, pa.binary()),
                    "prefix": _lists(prefixes),
                }
            )

    return saved(
        docs.mapInArrow(
            run, "doc_id long, n_shingles long, set_id long, bits binary, prefix array<long>"
        ),
        "prefixes",
    )


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int64()))


def _link(num: int, den: int, common, n_a, n_b):
    return common * den >= (n_a + n_b - common) * num


def _forest(sets: list[np.ndarray], inner: np.ndarray, num: int, den: int) -> list[tuple[int, int]]:
    """Links among sets as a spanning forest; pairs of inner sets are left out."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, place, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = df[place] >= 2
    _, place = np.unique(place[shared], return_inverse=True)
    owner = owner[shared]
    common = np.zeros((len(sets), len(sets)), dtype=np.float32)
    for start in range(0, int(place.max(initial=-1)) + 1, 4096):
        part = (place >= start) & (place < start + 4096)
        dense = np.zeros((len(sets), 4096), dtype=np.float32)
        dense[owner[part], place[part] - start] = 1
        common += dense @ dense.T
    linked = _link(num, den, np.rint(common).astype(np.int64), sizes[:, None], sizes[None, :])
    linked &= ~(inner[:, None] & inner[None, :])
    parent = list(range(len(sets)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for a, b in zip(*np.nonzero(np.triu(linked, 1)), strict=True):
        x, y = find(int(a)), find(int(b))
        if x != y:
            parent[x] = y
            out.append((int(a), int(b)))
    return out


def _compare(num: int, den: int):
    """Links of the clusters, or of the two blocks of one cluster, that a group holds."""

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, part in frame.drop_duplicates("set_id").groupby("root"):
            ids, sets = part["set_id"].tolist(), part["shingles"].tolist()
            inner = part["inner"].to_numpy(dtype=bool)
            if len(ids) == 2:
                common = len(np.intersect1d(*sets, assume_unique=True))
                found = [(0, 1)] * bool(_link(num, den, common, len(sets[0]), len(sets[1])))
            else:
                found = _forest(sets, inner, num, den) if len(ids) > 1 else []
            out += [(ids[a], ids[b]) for a, b in found]
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    return compare


def _sets(texts: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``set_id, root, shingles`` of the wanted sets, each from the document named for it."""
    rows_wanted = wanted.count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked, ids, sets = batch.column(0).to_pylist(), [], []
            for k, shingles in shingle_sets(batch.column(1), width):
                own = _set_id(shingles)
                # Equal ids may have other texts: only the row with the wanted set counts.
                if own is not None and asked[k] in (None, own):
                    ids.append(own)
                    sets.append(shingles.view(np.int64))
            yield pa.RecordBatch.from_pydict(
                {"set_id": pa.array(ids, pa.int64()), "shingles": _lists(sets)}
            )

    def few(df: DataFrame) -> DataFrame:
        return checked_broadcast(df, rows_wanted, BROADCAST_ROWS)

    named = texts.join(few(wanted.select("doc_id", "set_id")), "doc_id").select("set_id", "text")
    nameless = texts.where("doc_id is null").select(F.lit(None).cast("long"), "text")
    return (
        named.union(nameless)
        .mapInArrow(run, "set_id long, shingles array<long>")
        .join(few(wanted.select("set_id", "root")), "set_id")
    )


def _bound(num: int, den: int, apart, n_a, n_b):
    """Whether two sets whose bits differ in ``apart`` places may link."""
    return _link(num, den, np.minimum((n_a + n_b - apart) // 2, np.minimum(n_a, n_b)), n_a, n_b)


def _possible(pairs: DataFrame, nodes: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (``a, b``) whose bits allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apart = []
            for x, y in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True):
                x, y = (x, y) if len(x) <= len(y) else (y, x)
                wide, size = int.from_bytes(y, "little"), 4 * len(y)
                while size >= 8 * len(x):  # fold the longer one
                    wide = (wide >> size) ^ (wide & ((1 << size) - 1))
                    size //= 2
                apart.append((int.from_bytes(x, "little") ^ wide).bit_count())
            n_a, n_b = (batch.column(k).to_numpy() for k in (2, 3))
            kept = pa.array(_bound(num, den, np.array(apart, dtype=np.int64), n_a, n_b))
            yield pa.RecordBatch.from_arrays(
                [batch.column(k).filter(kept) for k in (0, 1)], names=["a", "b"]
            )

    def end(name: str) -> DataFrame:
        return nodes.select(
            F.col("set_id").alias(name), F.col("n").alias(f"n_{name}"), F.col("bits").alias(f"bits_{name}")
        )

    return (
        pairs.join(end("a"), "a").join(end("b"), "b")
        .select("a", "b", "n_a", "n_b", "bits_a", "bits_b")
        .mapInArrow(run, "a long, b long")
    )


def _near(num: int, den: int):
    """Spanning links (``a, b``) of the sets of a group whose bits allow a link; none of inner sets."""

    def near(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop_duplicates("set_id")
        ids, n = frame["set_id"].to_numpy(), frame["n"].to_numpy()
        inner = frame["inner"].to_numpy(dtype=bool)
        widths = frame["bits"].map(len).to_numpy()
        classes = {}
        for width in np.unique(widths):
            at = np.flatnonzero(widths == width)
            bits = np.frombuffer(b"".join(frame["bits"].iloc[at]), "<u8").reshape(len(at), -1)
            classes[width] = at, bits
        found = [(ids[:0], ids[:0])]
        for width, (at, bits) in classes.items():
            for other in sorted((w for w in classes if w <= width), reverse=True):
                to, others = classes[other]
                while bits.shape[1] > others.shape[1]:  # fold the longer ones
                    half = bits.shape[1] // 2
                    bits = bits[:, :half] ^ bits[:, half:]
                for k, own in zip(at, bits, strict=True):
                    apart = np.bitwise_count(others ^ own).sum(axis=1, dtype=np.int64)
                    linked = _bound(num, den, apart, n[k], n[to]) & (to != k)
                    if inner[k]:
                        linked &= ~inner[to]
                    hits = ids[to[linked]]
                    found.append((np.full(len(hits), ids[k]), hits))
        node, root = stars(*[np.concatenate(ends) for ends in zip(*found, strict=True)])
        return pd.DataFrame({"a": node, "b": root})[node != root]

    return near


def _crowded(heavy: DataFrame, crowds: DataFrame, num: int, den: int) -> DataFrame:
    """Rows of large buckets in which sets meet that share nothing else (``shingle, set_id``).

    Sets that share ``l`` large buckets still share one without the ``l - 1`` largest of each.
    """
    few = _matches(_need(F.col("n"), num, den), num, den)  # what any link of the set asks for
    place = F.row_number().over(Window.partitionBy("set_id").orderBy("members", "shingle"))
    rows = (
        heavy.join(crowds.withColumnRenamed("crowds", "own"), "set_id")
        .withColumn("few", few)
        .where("own >= few")
        .withColumn("place", place)
        .where("place <= own - few + 1")
        .select("shingle", "set_id")
    )
    return saved(rows, "crowded")


def _met_in_crowds(
    rows: DataFrame, nodes: DataFrame, known: DataFrame, num: int, den: int
) -> tuple[DataFrame, DataFrame]:
    """Candidates (``a, b``) of large buckets, as two tables, that connect all with the known ones."""
    pivots = rows.groupBy("shingle").agg(F.min("set_id").alias("low"))
    to_pivot = (
        rows.join(pivots, "shingle").where("set_id <> low")
        .select(F.col("set_id").alias("a"), F.col("low").alias("b")).distinct()
    )
    first = saved(_possible(to_pivot, nodes, num, den), "pivots")
    parts = components(known.union(first), "a", "b").withColumnRenamed("node", "set_id")
    rows = saved(
        rows.join(parts, "set_id", "left")
        .select("shingle", "set_id", F.coalesce("root", "set_id").alias("part")),
        "parts",
    )
    # Members of a bucket's largest part need no comparison among itself.
    by_part = rows.groupBy("shingle", "part").agg(F.count(F.lit(1)).alias("members"))
    main = by_part.groupBy("shingle").agg(
        F.max(F.struct("members", "part")).alias("main"), F.count(F.lit(1)).alias("parts")
    )
    members = rows.join(main.where("parts > 1"), "shingle").select(
        F.col("shingle").alias("root"), "set_id", (F.col("part") == F.col("main.part")).alias("inner")
    )
    across = (
        _dealt(saved(members, "apart"), BITS_BLOCK)
        .join(nodes, "set_id")
        .groupBy("root", "i", "j")
        .applyInPandas(_near(num, den), "a long, b long")
    )
    return first, saved(across, "across")


def candidates(facts: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs of sets (``a, b``) that connect all that may be linked, checked by their bits."""
    rows = facts.where("set_id is not null").select(
        F.explode("prefix").alias("shingle"), "set_id", F.col("n_shingles").alias("n")
    )
    buckets = rows.groupBy("shingle").agg(F.min("set_id").alias("low"), F.max("set_id").alias("high"))
    # Copies are counted out here: what is left has a row per shingle and node.
    shared = saved(
        rows.join(buckets.where("low < high").select("shingle"), "shingle")
        .groupBy("shingle", "set_id")
        .agg(F.min("n").alias("n")),
        "buckets",
    )
    sizes = shared.groupBy("shingle").agg(F.count(F.lit(1)).alias("members"))
    large = saved(sizes.where(F.col("members") > BUCKET), "large")
    heavy = saved(shared.join(large, "shingle"), "heavy")
    crowds = saved(heavy.groupBy("set_id").agg(F.count(F.lit(1)).alias("crowds")), "crowds")
    crowds_of = checked_broadcast(crowds, crowds.count(), BROADCAST_ROWS)
    small = shared.join(sizes.where(F.col("members") <= BUCKET), "shingle").select(
        "shingle", "set_id", "n"
    )
    other = small.select("shingle", *[F.col(c).alias(f"{c}_b") for c in small.columns[1:]])
    least = F.least("n", "n_b")
    met = (
        small.join(other, "shingle")
        .where((F.col("set_id") < F.col("set_id_b")) & (least * den >= F.greatest("n", "n_b") * num))
        .groupBy(F.col("set_id").alias("a"), F.col("set_id_b").alias("b"))
        .agg(F.count(F.lit(1)).alias("met"), F.min(least).alias("n"))
    )
    for end in "a", "b":
        own = crowds_of.select(F.col("set_id").alias(end), F.col("crowds").alias(f"crowds_{end}"))
        met = met.join(own, end, "left")
    none = F.lit(0)
    unseen = F.least(F.coalesce("crowds_a", none), F.coalesce("crowds_b", none))
    pairs = saved(
        met.where(F.col("met") + unseen >= _matches(F.col("n"), num, den)).select("a", "b"), "pairs"
    )
    rows = _crowded(heavy, crowds, num, den)
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("set_id")).union(rows.select("set_id"))
    wanted = saved(wanted.distinct(), "met")
    nodes = saved(
        facts.join(checked_broadcast(wanted, wanted.count(), BROADCAST_ROWS), "set_id")
        .groupBy("set_id")
        .agg(F.min("n_shingles").alias("n"), F.min("bits").alias("bits")),
        "nodes",
    )
    known = saved(_possible(pairs, nodes, num, den), "possible")
    if rows.isEmpty():
        return known
    first, across = _met_in_crowds(rows, nodes, known, num, den)
    return known.union(first).union(across)


def links(docs: DataFrame, facts: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """Links between different sets (``a, b``) that join all that are connected."""
    clusters = components(candidates(facts, num, den), "a", "b")
    sizes = clusters.groupBy("root").agg(F.count(F.lit(1)).alias("members"))
    wanted = saved(
        facts.select("doc_id", "set_id")
        .join(clusters.withColumnRenamed("node", "set_id"), "set_id")
        .join(sizes, "root")
        .groupBy("set_id", "root", "members")
        .agg(F.min("doc_id").alias("doc_id")),
        "wanted",
    )
    compare, found = _compare(num, den), "a long, b long"
    few = wanted.where(F.col("members") <= BLOCK)
    bins = groups_of(few.count(), 4 * BLOCK)
    near = (
        _sets(docs, few, width)
        .select("set_id", "root", "shingles", F.lit(False).alias("inner"))
        .groupBy(F.pmod(F.xxhash64("root"), F.lit(bins)).alias("bin"))
        .applyInPandas(compare, found)
    )
    many = wanted.where(F.col("members") > BLOCK)
    if many.isEmpty():
        return near
    sets = saved(_sets(docs, many, width), "sets")
    centre = sets.where("set_id = root").select("root", F.col("shingles").alias("centre"))
    common = F.size(F.array_intersect("shingles", "centre"))
    star = saved(
        sets.join(centre, "root")
        .where(_link(num, den, common, F.size("shingles"), F.size("centre")))
        .select("set_id", "root")
        .distinct(),
        "star",
    )
    members = many.select("root", "set_id").join(
        star.select("set_id", F.lit(True).alias("inner")), "set_id", "left"
    )
    dealt = _dealt(members.withColumn("inner", F.coalesce("inner", F.lit(False))), BLOCK)
    across = (
        dealt.join(sets.drop("root"), "set_id").groupBy("root", "i", "j").applyInPandas(compare, found)
    )
    return near.union(star.where("set_id <> root")).union(across)


def _dealt(members: DataFrame, size: int) -> DataFrame:
    """Members (``root, set_id, inner``) by pairs of blocks (``i, j``); two inner ones do not meet."""
    counts = members.groupBy("root", "inner").agg(F.count(F.lit(1)).alias("n"))
    blocks = counts.groupBy("root").agg(
        F.sum(F.when(F.col("inner"), F.ceil(F.col("n") / size))).alias("inner_blocks"),
        F.sum(F.when(~F.col("inner"), F.ceil(F.col("n") / size))).alias("outer_blocks"),
    )
    # Inner blocks come first; without outer members a cluster is settled.
    blocks = blocks.where("outer_blocks > 0").select(
        "root", F.coalesce("inner_blocks", F.lit(0)).alias("inner_blocks"), "outer_blocks"
    )
    spot = F.xxhash64("set_id", F.lit(3))
    own = F.when(F.col("inner"), F.pmod(spot, F.col("inner_blocks"))).otherwise(
        F.col("inner_blocks") + F.pmod(spot, F.col("outer_blocks"))
    )
    last = F.col("inner_blocks") + F.col("outer_blocks") - 1
    partners = F.when(
        F.col("own") < F.col("inner_blocks"), F.sequence(F.col("inner_blocks"), last)
    ).otherwise(F.sequence(F.lit(0).cast("long"), last))
    return (
        members.join(blocks, "root")
        .withColumn("own", own)
        .withColumn("partner", F.explode(partners))
        .select(
            "root", "set_id", "inner", F.least("own", "partner").alias("i"),
            F.greatest("own", "partner").alias("j"),
        )
    )


def join(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
    num: int = 80, den: int = 100,
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document.

    Documents link when ``den * intersection >= num * union`` of their sets of distinct
    ``width``-word shingles (A-Z lower-cased; shorter texts are one shingle). ``component_id`` is
    the smallest id reachable by links, the own one included. Texts without words, empty or null,
    have no shingle and link with nothing. Repeated rows and copies are linked. Documents without
    an id link like others but give no component their id: it is null where nobody has one. An
    empty table gives no rows; other columns are ignored.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    facts = describe(docs, "text", width, num, den)
    groups = components(links(docs, facts, width, num, den), "a", "b")
    classes = (
        facts.where("set_id is not null").groupBy("set_id")
        .agg(F.min("doc_id").alias("first"))
        .join(groups.withColumnRenamed("node", "set_id"), "set_id", "left")
        .withColumn("root", F.coalesce("root", "set_id"))
    )
    least = classes.groupBy("root").agg(F.min("first").alias("component_id"))
    named = classes.select("set_id", "root").join(least, "root").select("set_id", "component_id")
    return facts.select("doc_id", "n_shingles", "set_id").join(named, "set_id", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
        .alias("component_id"),
    )


def distinct_documents(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
    num: int = 80, den: int = 100,
) -> DataFrame:
    """``docs`` with one document of each group that links join: the one with the smallest id.

    Texts without words stay. Where ids are missing or repeat, rows are told apart by their number
    and the first row of a group stays.
    """
    rows, row = numbered(docs, id_col)
    found = join(rows, id_col=row, text_col=text_col, width=width, num=num, den=den)
    gone = saved(found.where("component_id <> doc_id").select(F.col("doc_id").alias(row)), "copies")
    few = checked_broadcast(gone, gone.count(), BROADCAST_ROWS)
    return rows.join(few, row, "left_anti").select(*columns_of(docs))
