"""Grouping of spelling variants by pivotal grams.

Two words are near if one code point inserted, deleted or replaced makes one the other. Bigrams are
ordered from rare to frequent over all words. A word's prefix is its rarest three bigrams (and those
that tie with the last of them); among these, two that do not overlap and are together the rarest
are its pivots, chosen by dynamic programming. One edit cannot touch both. So if the last bigram of
word r's prefix is no more frequent than that of s, then a pivot of r survives in s, and there it
belongs to the prefix of s: pivots are looked up in prefixes, not bigrams in bigrams.

Position limits: the edit lies on one side of the surviving pivot. What is on the other side is the
same in both words, so the pivot's distance from the word's start, or from its end, is the same too.
On the side of the edit the first or the last half of the code points stays. The same text and that
half are the join key, which leaves few candidates for the exact check.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import saved

# The alphabet of the contract: ASCII letters and the upper half of Latin-1.
LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPOILED = 199
GRAM, PREFIX, PIVOTS = 2, 3, 2


def spoil(run: Column, doc_id: Column) -> Column:
    """The run, without one of its code points where crc32 of the id and the run says so."""
    key = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run)
    h = F.crc32(key.cast("binary"))
    at = F.pmod(h, F.length(run)).cast("int")
    less = F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2))
    return F.when(h % SPOILED == 0, less).otherwise(run)


def word_counts(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shortest: int = 6,
    fewest: int = 5,
) -> DataFrame:
    """``word, n`` of the words with enough code points and occurrences.

    Counted on the map side first, so a frequent word is one row per task in the shuffle.
    """
    # A run that is too short stays too short, and the pattern takes whole runs.
    runs = F.regexp_extract_all(
        F.translate(F.col("text"), UPPER, LOWER), F.lit(f"[{LETTERS}]{{{shortest},}}"), 0
    )
    return (
        docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
        .select("doc_id", F.explode(runs).alias("run"))
        .select(spoil(F.col("run"), F.col("doc_id")).alias("word"))
        .where(F.length("word") >= shortest)
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= fewest)
    )


def gram_ranks(words: DataFrame) -> dict[str, int]:
    """Position of every bigram in the order from rare to frequent.

    Letters are ASCII lower case or one of 64 others, so there are at most 90 * 90 bigrams.
    """
    at = F.sequence(F.lit(1), F.length("word") - (GRAM - 1))
    grams = words.select(F.explode(F.transform(at, lambda i: F.substr("word", i, F.lit(GRAM)))).alias("gram"))
    rows = grams.groupBy("gram").count().orderBy("count", "gram").collect()
    return {row["gram"]: k for k, row in enumerate(rows)}


def prefix_grams(word: str, ranks: dict[str, int]) -> list[tuple[int, int]]:
    """(position, rank) of the rarest bigrams by position, with all that tie with the last."""
    grams = [(p, ranks[word[p : p + GRAM]]) for p in range(len(word) - GRAM + 1)]
    last = sorted(rank for _, rank in grams)[min(PREFIX, len(grams)) - 1]
    return [(p, rank) for p, rank in grams if rank <= last]


def pivots(grams: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The disjoint bigrams of least total rank, by dynamic programming over their positions.

    ``best[j]`` is the cheapest choice of ``j`` bigrams among those seen; a bigram is added to the
    choice that was best before the first bigram it overlaps.
    """
    history = [[(0, [])] + [(float("inf"), [])] * PIVOTS]
    for k, (position, rank) in enumerate(grams):
        before = k
        while before and grams[before - 1][0] + GRAM > position:
            before -= 1
        best = list(history[-1])
        for j in range(1, PIVOTS + 1):
            cost, chosen = history[before][j - 1]
            if cost + rank < best[j][0]:
                best[j] = (cost + rank, [*chosen, (position, rank)])
        history.append(best)
    return history[-1][PIVOTS][1]


def side_keys(same: str, edited: str) -> list[tuple[str, str]]:
    """Keys of a word by the text that stays, and half of the other side that may stay.

    Of two sides that are one edit apart, the shorter with ``m`` code points, the first or the last
    ``m // 2`` are the same. The side may be the shorter or the longer one: ``m`` is its length or
    one less.
    """
    size, out = len(edited), []
    for half in sorted({size // 2, max(size - 1, 0) // 2}):
        if half:
            out += [(same, "<" + edited[:half]), (same, ">" + edited[-half:])]
        else:
            out.append((same, ""))
    return out


def _keys(ranks: dict[str, int]):
    """Rows of a word: its prefix, pivots marked, each by the text before and after it."""

    def keys(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for word, n in zip(frame["word"], frame["n"], strict=True):
                grams = prefix_grams(word, ranks)
                last = max(rank for _, rank in grams)
                chosen = set(pivots(grams))
                for gram in grams:
                    start, end = gram[0], gram[0] + GRAM
                    for head, found in (
                        (True, side_keys(word[:end], word[end:])),
                        (False, side_keys(word[start:], word[:start])),
                    ):
                        out += [(same, part, head, gram in chosen, last, word, n) for same, part in found]
            yield pd.DataFrame(out, columns=["same", "part", "head", "pivot", "last", "word", "n"])

    return keys


def near_words(words: DataFrame) -> DataFrame:
    """Pairs of words (``a < b``) that are one edit apart, with their counts."""
    rows = saved(
        words.mapInPandas(
            _keys(gram_ranks(words)),
            "same string, part string, head boolean, pivot boolean, last int, word string, n long",
        ),
        "grams",
    )
    key = ["same", "part", "head"]

    def side(df: DataFrame, end: str) -> DataFrame:
        return df.select(*key, *[F.col(c).alias(f"{c}_{end}") for c in ("last", "word", "n")])

    found = (
        side(rows.where("pivot"), "a").join(side(rows, "b"), key)
        .withColumnsRenamed({"word_a": "a", "word_b": "b"})
        .where((F.col("last_a") <= F.col("last_b")) & (F.col("a") != F.col("b")))
        .where(F.abs(F.length("a") - F.length("b")) <= 1)
        .where(F.levenshtein("a", "b", 1) == 1)
    )
    first = F.col("a") < F.col("b")

    def end(yes: str, no: str) -> Column:
        return F.when(first, F.col(yes)).otherwise(F.col(no))

    return found.select(
        end("a", "b").alias("a"), end("n_a", "n_b").alias("n_a"),
        end("b", "a").alias("b"), end("n_b", "n_a").alias("n_b"),
    ).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of the words whose form has a form itself: where the forms end.

    A round is a step, and only words that took it are written and go on. A form is ``ratio`` times
    as frequent as its word, so a path has no circle and few steps, and few words take many.
    """
    ahead = forms.select(F.col("word").alias("root"), F.col("form").alias("further"))
    going, ends = forms.select("word", F.col("form").alias("root")), None
    for step in itertools.count():
        longer = going.join(ahead, "root").select(
            "word", F.col("further").alias("root"), F.lit(step).alias("step")
        )
        going = saved(longer, "forms")
        ends = going if ends is None else ends.union(going)
        if going.isEmpty():
            return ends.groupBy("word").agg(F.max_by("root", "step").alias("root"))


def variants(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shortest: int = 6,
    fewest: int = 5, ratio: int = 5,
) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every word of the texts.

    Words are maximal runs of letters (A-Z lower-cased, other letters as they are) with at least
    ``shortest`` code points and ``fewest`` occurrences; in one of 199 pairs of document and run,
    a code point is taken out first. ``form`` is the near word of largest ``n`` (ties: the smallest
    in code-point order) if that is at least ``ratio`` times the word's, else null. ``root`` is
    where the forms end, or the word itself.

    Null and empty texts have no words; repeated rows count each. A null id stands for empty text in
    the hash. ``shortest`` is at least 4 (so that three bigrams hold two disjoint ones). An empty
    table gives no rows; other columns are ignored.
    """
    if shortest < PREFIX + 1 or ratio < 2:
        raise ValueError("words need four code points, and a form more occurrences than its word")
    words = saved(
        word_counts(docs, id_col=id_col, text_col=text_col, shortest=shortest, fewest=fewest), "words"
    )

    def end(word: str, other: str, n: str) -> Column:
        return F.struct(F.col(word).alias("word"), F.col(other).alias("other"), F.col(n).alias("n"))

    both = near_words(words).select(F.inline(F.array(end("a", "b", "n_b"), end("b", "a", "n_a"))))
    # The smallest of (-n, word) is the most frequent, then the first in code-point order.
    near = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n")).alias("minus"), "other")).alias("top")
    )
    described = words.join(near, "word", "left").withColumn("top_n", -F.col("top.minus"))
    fits = F.col("top_n") >= F.col("n") * ratio
    described = saved(
        described.select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(fits, F.col("top.other")).alias("form"), F.when(fits, F.col("top_n")).alias("form_n"),
        ),
        "described",
    )
    ends = roots(described.where("form is not null"))
    return described.join(ends, "word", "left").withColumn("root", F.coalesce("root", "form", "word"))


def oracle() -> str:
    """The same in SQL, for small tables: all pairs of words, and crc32 bit by bit."""
    plain = "".join(chr(c) for c in range(0xC0, 0x100))
    # levenshtein counts bytes: the 64 other letters stand in as one-byte characters.
    other = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789!#$%&()*+,-./:;<=>?@[]^_{|}~"
    return f"""
with bits as (
  select list(c order by i) as t from (
    select i, list_reduce(list_prepend(i::bigint, range(8)::bigint[]),
      lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as c
    from range(256) r(i))
), runs as (
  select coalesce(doc_id::varchar, '') as doc,
    unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[{LETTERS}]+')) as run
  from documents
), keyed as (
  select run, count(*) as times, hex(encode(doc || ':' || run)) as code from runs
  where length(run) >= 6 group by run, doc
), hashed as (
  select run, times, xor(4294967295, list_reduce(
    list_prepend(4294967295::bigint, list_transform(range(0, length(code), 2),
      lambda i: ('0x' || substr(code, (i + 1)::bigint, 2))::bigint)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) as h
  from keyed, bits
), words as (
  select case when h % 199 = 0
    then substr(run, 1, (h % length(run))::bigint) || substr(run, (h % length(run))::bigint + 2)
    else run end as word, sum(times)::bigint as n
  from hashed group by 1 having length(word) >= 6 and sum(times) >= 5
), coded as (
  select word, n, length(word) as len, translate(word, '{plain}', '{other}') as code from words
), near as (
  select a.word, a.n, b.word as other, b.n as other_n from coded a join coded b
  on b.len between a.len - 1 and a.len + 1 and a.word <> b.word and levenshtein(a.code, b.code) = 1
), chosen as (
  select word, count(*) as n_near, first(other order by other_n desc, encode(other)) as other,
    max(other_n) as other_n
  from near group by word
), described as (
  select w.word, w.n, coalesce(c.n_near, 0)::bigint as n_near,
    case when c.other_n >= 5 * w.n then c.other end as form,
    case when c.other_n >= 5 * w.n then c.other_n end as form_n
  from words w left join chosen c using (word)
), paths as (
  with recursive path as (
    select word, word as stop, 0 as steps from described
    union all
    select p.word, d.form, p.steps + 1 from path p join described d on d.word = p.stop
    where d.form is not null
  ) select word, arg_max(stop, steps) as root from path group by word
)
select word, n, n_near, form, form_n, root from described join paths using (word)
"""
