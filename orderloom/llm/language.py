"""Language identification by cross-parsing entropy.

A suffix automaton of labelled text per language yields the longest match from any position. A text
is cut into phrases, each the longest that the language's sample has; the more alien the language,
the more phrases. With c phrases, n characters of sample and m characters of text the estimate of
the cross entropy is c log2(n) / m, and the language with the lowest one wins. Phrases stay inside a
word and its two boundaries, so a word's count is worked out once per task.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import held_out
from orderloom.llm.hashing import batches_of

# Sample per language, and of all languages together, in characters; learned languages.
SAMPLE, ALL_SAMPLES, MAX_LANGUAGES = 40_000, 4_000_000, 1_000
UNKNOWN = "und"
WORDS = re.compile(r"[^\W\d_]+")
GROUP, KEPT = 4_000_000, 500_000


class SuffixAutomaton:
    """All substrings of a text, as transitions per state."""

    def __init__(self, text: str):
        self.next: list[dict[str, int]] = [{}]
        link, length = [-1], [0]
        last = 0
        for char in text:
            state = len(self.next)
            self.next.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and char not in self.next[p]:
                self.next[p][char] = state
                p = link[p]
            if p >= 0:
                q = self.next[p][char]
                if length[p] + 1 == length[q]:
                    link[state] = q
                else:
                    copy = len(self.next)
                    self.next.append(dict(self.next[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p >= 0 and self.next[p].get(char) == q:
                        self.next[p][char] = copy
                        p = link[p]
                    link[q] = link[state] = copy
            last = state

    def phrases(self, text: str) -> int:
        """Parts of a text if each is the longest match; a character without match is a part."""
        table, count, state = self.next, 0, 0
        root = table[0]
        for char in text:
            after = table[state].get(char)
            if after is None:
                # The match ends before this character, which begins the next one.
                count += state > 0
                after = root.get(char)
                if after is None:
                    count += 1
                    after = 0
            state = after
        return count + (state > 0)


def letters(word: str) -> str:
    return "".join(c for c in word if c.isalpha())


def sample_text(texts: list[str], limit: int) -> str:
    """Words of the texts, bounded by spaces, up to ``limit`` characters."""
    out, size = [], 1
    for text in texts:
        for word in map(letters, WORDS.findall(text.lower())):
            if word:
                if size >= limit:
                    return " " + "".join(out)
                out.append(word + " ")
                size += len(word) + 1
    return " " + "".join(out)


class Model:
    """Automata of all languages, built once per worker, with the words met so far."""

    def __init__(self, samples: dict[str, str]):
        self.languages = sorted(samples)
        self.automata = [SuffixAutomaton(samples[k]) for k in self.languages]
        self.bits = np.log2([max(2, len(samples[k])) for k in self.languages])
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.rows = np.zeros((0, len(self.languages) + 1), dtype=np.int32)

    def learn(self, words: set[str]) -> None:
        new, rows = sorted(words - self.place.keys()), []
        for word in new:
            own = letters(word)
            unit = f" {own} "
            rows.append(
                [a.phrases(unit) for a in self.automata] + [len(unit)]
                if own else [0] * (len(self.automata) + 1)
            )
        first = len(self.place)
        self.place.update(zip(new, range(first, first + len(new)), strict=True))
        if rows:
            self.rows = np.concatenate([self.rows, np.array(rows, dtype=np.int32)])

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        parts = [WORDS.findall(t.lower()) if t else [] for t in texts]
        wanted = set().union(*parts)
        if len(self.place) + len(wanted) > KEPT:
            self.forget()
        self.learn(wanted)
        place = self.place
        codes = np.array([place[w] for p in parts for w in p], dtype=np.int64)
        counts = np.array([len(p) for p in parts], dtype=np.int64)
        totals = np.zeros((len(texts), len(self.languages) + 1))
        some = np.flatnonzero(counts)
        if len(some):
            starts = (np.cumsum(counts) - counts)[some]
            totals[some] = np.add.reduceat(self.rows[codes].astype(np.int64), starts, axis=0)
        size = totals[:, -1:]
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        entropy = totals[:, :-1] * self.bits / np.maximum(size, 1)
        best = entropy.argmin(axis=1)
        weight = 2.0 ** -((entropy - entropy.min(axis=1, keepdims=True)) * np.sqrt(size))
        score = np.where(size[:, 0] > 0, 1 / weight.sum(axis=1), 0.0)
        names = [
            self.languages[k] if m > 0 else UNKNOWN
            for k, m in zip(best.tolist(), size[:, 0].tolist(), strict=True)
        ]
        return names, score


_MODELS: dict[int, Model] = {}


def learn_samples(
    docs: DataFrame, *, id_col: str, text_col: str, lang_col: str, sample: int, seed: int
) -> dict[str, str]:
    """Up to ``sample`` characters per language, from documents in the order of a seeded hash.

    The hash is of id and text, so rows without an id are told apart; rows that agree in both count
    once. Documents count where it is below the language's share, which is set from the counts of all
    documents so that about four times the sample reaches the driver. Of a long text only a stretch at
    a seeded place counts: a sixteenth of the sample, more only where a language has few texts.
    """
    train = docs.where(
        F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~held_out(id_col, 3, 1)
    ).select(
        F.col(lang_col).alias("lang"),
        F.col(text_col).alias("text"),
        (F.xxhash64(F.col(id_col), F.col(text_col), F.lit(seed)) / F.lit(2.0**64) + 0.5).alias("at"),
    )
    different = train.groupBy("lang", "at").agg(F.max(F.length("text")).alias("size"))
    sizes = (
        different.groupBy("lang").agg(F.sum("size").alias("chars"), F.count("*").alias("n"))
        .limit(MAX_LANGUAGES + 1).collect()
    )
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not sizes:
        return {}
    sample = min(sample, max(1_000, ALL_SAMPLES // len(sizes)))
    plans = []
    for r in sizes:
        share = min(1.0, max(4 * sample / max(1, r["chars"]), 32 / r["n"]))
        stretch = max(sample // 16, math.ceil(2 * sample / max(1, r["n"] * share)))
        plans.append((r["lang"], share, stretch))
    plans = docs.sparkSession.createDataFrame(plans, "lang string, share double, stretch int")
    begin = F.pmod(F.xxhash64("at", F.lit(seed)), F.greatest(F.lit(1), F.length("text") - F.col("stretch")))
    rows = (
        train.join(F.broadcast(plans), "lang")
        .where(F.col("at") <= F.col("share"))
        .select(
            "lang", "at", (F.length("text") > F.col("stretch")).alias("cut"),
            F.substr("text", begin.cast("int") + 1, F.col("stretch")).alias("text"),
        )
        .dropDuplicates(["lang", "at"])
        .collect()
    )
    by: dict[str, list] = {}
    for row in sorted(rows, key=lambda r: (r["lang"], r["at"], r["text"])):
        # The words at the ends of a stretch may be cut.
        text = row["text"].partition(" ")[2].rpartition(" ")[0] if row["cut"] else row["text"]
        by.setdefault(row["lang"], []).append(text or row["text"])
    samples = {k: sample_text(v, sample) for k, v in by.items()}
    return {k: v for k, v in samples.items() if v.strip()}


def identify(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    sample: int = SAMPLE, seed: int = 5,
) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document.

    The language with the lowest cross entropy over the whole text wins, the first by code point
    among equals. ``score`` is the share of 2^(-entropy sqrt(length)) among all languages, from 0 to
    1. Null texts and texts without a letter are ``und`` with score 0, as is everything if nothing
    could be learned. Null languages teach nothing; null ids are never held out; repeated rows are
    each returned; an empty table gives no rows; other columns are ignored. Models are fitted on at
    most ``sample`` characters per language (4 million for all); predictions use whole texts.
    """
    spark = docs.sparkSession
    samples = learn_samples(
        docs, id_col=id_col, text_col=text_col, lang_col=lang_col, sample=sample, seed=seed
    )
    shared = spark.sparkContext.broadcast(samples)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key = hash(tuple(sorted(shared.value.items())))
        if key not in _MODELS:
            _MODELS.clear()
            _MODELS[key] = Model(shared.value)
        model = _MODELS[key]
        for frame in frames:
            texts = frame["text"].tolist()
            names, scores = [], []
            for start, stop in batches_of(texts, GROUP):
                some, values = model.predict(texts[start:stop])
                names += some
                scores.append(values)
            if names:
                yield pd.DataFrame(
                    {
                        "doc_id": frame["doc_id"],
                        "held_out": frame["held_out"],
                        "lang_pred": names,
                        "score": np.concatenate(scores),
                    }
                )

    # Ids travel as text: a column of numbers with nulls would become floating point.
    return (
        docs.select(
            F.col(id_col).cast("string").alias("doc_id"),
            F.col(text_col).alias("text"),
            held_out(id_col, 3, 1).alias("held_out"),
        )
        .mapInPandas(run, "doc_id string, held_out boolean, lang_pred string, score double")
        .withColumn("doc_id", F.col("doc_id").cast("long"))
    )
