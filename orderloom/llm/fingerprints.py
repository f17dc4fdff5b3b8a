"""Document fingerprints by one-permutation MinHash, all in Spark's own functions.

Every shingle is hashed once. Its leading bits choose one of 256 bins and a bin keeps its smallest
hash. An empty bin borrows from another one by optimal densification: every bin has a fixed order in
which it asks the others (the same for all documents) and takes the first that is not empty. Of each
bin the low 8 bits are stored; likeness corrects for bits that agree by chance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderloom.llm.common import SPACE, fresh, let

BINS, BITS, WIDTH = 256, 8, 5
# Attempts by hash before all bins that are not empty are ranked.
ATTEMPTS = 6
_LOW = (1 << 56) - 1


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def words_of(text: Column) -> Column:
    """Lower-cased words between white space; none for null."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), SPACE), "")


def shingles(words: Column, width: int) -> Column:
    """Hashes of all runs of ``width`` words; of the whole sequence where it is shorter."""
    n = F.size(words)
    every = F.transform(
        F.sequence(F.lit(0), n - width),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(width)]),
    )
    return (
        F.when(n >= width, every)
        .when(n > 0, F.array(F.xxhash64(F.array_join(words, " "))))
        .otherwise(F.array().cast("array<bigint>"))
    )


def _bin(x: Column) -> Column:
    return F.shiftright(x, 56)


def _full(x: Column) -> Column:
    return x.bitwiseAND(_long(_LOW)) != _long(_LOW)


def _densified(bins: Column) -> Column:
    """The 8 low bits of each bin, as whole numbers from -128, where at least one bin is full."""
    low = [*range(BINS)]

    def code(x: Column) -> Column:
        return (x.bitwiseAND(_long(255)) - 128).cast("tinyint")

    def borrowed(full: Column):
        def of(x: Column, i: Column) -> Column:
            out = F.when(_full(x), code(x))
            for attempt in range(ATTEMPTS):
                donor = F.get(bins, F.pmod(F.xxhash64(i, F.lit(attempt)), F.lit(BINS)).cast("int"))
                out = out.when(_full(donor), code(donor))
            ranks = F.transform(
                full,
                lambda j: F.shiftleft(F.shiftrightunsigned(F.xxhash64(i, F.lit(-1), j), 9), 8)
                .bitwiseOR(j.cast("long")),
            )
            first = F.array_min(ranks).bitwiseAND(_long(BINS - 1)).cast("int")
            return out.otherwise(code(F.get(bins, first)))

        return of

    full = F.filter(F.array(*map(F.lit, low)), lambda j: _full(F.get(bins, j)))
    return let(full, lambda f: F.transform(bins, borrowed(f)))


def codes(text: Column, width: int = WIDTH) -> Column:
    """The fingerprint as an array of 256 small numbers; empty for a text without words."""
    # An entry for each bin that sorts behind all others of it marks the bin's end.
    ends = F.array(*[F.lit((b - BINS // 2 << 56) | _LOW).cast("long") for b in range(BINS)])

    def from_sorted(s: Column) -> Column:
        return F.filter(s, lambda x, i: (i == 0) | (_bin(x) != _bin(F.get(s, i - 1))))

    return let(
        words_of(text),
        lambda words: F.when(F.size(words) == 0, F.array().cast("array<tinyint>")).otherwise(
            let(
                F.sort_array(F.concat(shingles(words, width), ends)),
                lambda s: let(from_sorted(s), _densified),
            )
        ),
    )


def packed(codes_col: Column) -> Column:
    """Two hexadecimal digits per bin; an empty string for a text without words."""

    def eight(k: Column) -> Column:
        total = _long(0)
        for place in range(8):
            value = F.get(codes_col, k * 8 + place).cast("long") + 128
            total = total.bitwiseOR(F.shiftleft(value, 56 - 8 * place))
        return F.lower(F.lpad(F.hex(total), 16, "0"))

    whole = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(BINS // 8 - 1)), eight), "")
    return F.when(F.size(codes_col) > 0, whole).otherwise(F.lit(""))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two arrays of codes, corrected for chance agreement.

    1 for two texts without words, 0 for one of them and another text.
    """
    same = F.size(
        F.filter(
            F.sequence(F.lit(0), F.lit(BINS - 1)), lambda i: F.get(a, i) == F.get(b, i)
        )
    )
    chance = 1 / (1 << BITS)
    share = (same / F.lit(float(BINS)) - chance) / (1 - chance)
    return (
        F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0)
        .when((F.size(a) == 0) | (F.size(b) == 0), 0.0)
        .otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), share)))
    )


def fingerprint(docs: DataFrame, *, text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """All columns of ``docs`` and ``fingerprint`` (a column of that name is replaced).

    A null text counts as empty; its fingerprint is the empty string. Equal texts have equal ones.
    """
    return docs.withColumn("fingerprint", packed(codes(F.col(text_col), width)))


def _slices(docs: DataFrame, id_col: str, digest: Column, count: int) -> Column:
    """Number of an id's slice, ascending by (id, digest); slices are about equally large.

    An id that fills several slices is dealt over them by the digest.
    """
    cuts = docs.agg(
        F.percentile_approx(id_col, [k / count for k in range(1, count)], 100 * count)
    ).first()[0]
    if not cuts:
        return F.lit(0)
    table = F.array(*[F.lit(c).cast("long") for c in cuts])
    step = max(1, int(len(cuts) ** 0.5))
    # Cuts are looked up in two steps: every step-th one, then those in between.
    coarse = F.array(*[F.lit(c).cast("long") for c in cuts[::step]])
    value = F.col(id_col)

    def below(k: Column) -> Column:
        start = F.greatest(F.lit(0), (k - 1) * step)
        return F.when(k == 0, 0).otherwise(
            start + F.size(F.filter(F.slice(table, start + 1, F.lit(step)), lambda c: c < value))
        )

    first = let(F.size(F.filter(coarse, lambda c: c < value)), below)
    own = {}
    for c in cuts:
        own[c] = own.get(c, 0) + 1
    repeated = {c: m for c, m in own.items() if m > 1}
    spread = F.lit(0)
    for c, m in repeated.items():
        part = F.floor((digest / F.lit(2.0**64) + 0.5) * m)
        spread = F.when(value == c, F.least(part, F.lit(m - 1)).cast("int")).otherwise(spread)
    return F.coalesce(first + spread, F.lit(0))


def edited_fingerprints(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH
) -> DataFrame:
    """Fingerprints of every text and of its edit, and how alike they look.

    The edit replaces the last half (rounded down) of a text's code points by the first as many, or
    all, of the next document by ascending id; the first follows the last. Returns ``doc_id,
    n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``. Null texts
    are empty. Null ids come first; rows with equal ids follow each other by a hash of the text, so
    repeated rows are each other's next. A single document follows itself. An empty table gives no
    rows; other columns are ignored.

    Texts are shuffled once, into slices of neighbouring ids. The first row of a slice is also sent
    to the end of the slice before, so that no row looks beyond its slice.
    """
    spark = docs.sparkSession
    digest, part, ghost = fresh(docs, "digest", "part", "ghost")
    base = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    ).withColumn(digest, F.xxhash64("text"))
    count = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = base.withColumn(part, _slices(base.select("doc_id"), "doc_id", F.col(digest), count))
    heads = sorted(
        base.groupBy(part).agg(F.min(F.struct("doc_id", digest)).alias("first")).collect(),
        key=lambda r: r[0],
    )  # one row per slice
    if not heads:
        heads = [(0, (None, 0))]
    before = [(heads[k - 1][0], *heads[k][1]) for k in range(len(heads))]
    ends = spark.createDataFrame(before, f"{ghost} int, id long, digest long")
    ghosts = (
        base.drop(part)
        .join(F.broadcast(ends), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col(digest) == F.col("digest")))
        .select("doc_id", "text", digest, F.col(ghost).alias(part), F.lit(1).alias(ghost))
    )
    every = base.withColumn(part, F.col(part).cast("int")).withColumn(ghost, F.lit(0))
    rows = every.unionByName(ghosts).withColumn("codes", codes(F.col("text"), width))
    order = Window.partitionBy(part).orderBy(ghost, F.col("doc_id").asc_nulls_first(), digest)
    half = F.floor(F.length("text") / 2).cast("int")
    paired = (
        rows.select(
            "*", F.lead("text").over(order).alias("next_text"),
            F.lead("codes").over(order).alias("next_codes"),
        )
        .where(F.col(ghost) == 0)
        .withColumn(
            "edited",
            F.concat(
                F.substring("text", F.lit(1), F.length("text") - half),
                F.substring("next_text", F.lit(1), half),
            ),
        )
        .withColumn("edited_codes", codes(F.col("edited"), width))
    )
    return paired.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        packed(F.col("codes")).alias("fingerprint"),
        packed(F.col("edited_codes")).alias("edited_fingerprint"),
        likeness(F.col("codes"), F.col("edited_codes")).alias("near_edited"),
        likeness(F.col("codes"), F.col("next_codes")).alias("near_next"),
    )
