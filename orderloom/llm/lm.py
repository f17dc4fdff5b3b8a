"""Score texts with a weighted backoff automaton of smoothed word n-grams.

States are the contexts seen in training, of up to ``order - 1`` tokens (words and the start of a
text), and the root. A state has an arc per token that was seen after it, weighted with the
log-probability of that token, and a failure arc to the state of its context without the first
token, weighted with the mass it leaves for all other tokens. Smoothing is a Dirichlet prior: with
``m`` the prior's strength, c(h) how often a context h was seen and P(w | h') the estimate after the
context one token shorter (at the root the add-one estimate of w),

    arc      (c(h, w) + m P(w | h')) / (c(h) + m)
    failure  m / (c(h) + m)

so the probabilities after every state add up to one, and a state's failure weight depends on its
own count only. An arc leads to the longest context of which training knows the end of the text read
so far. No n-gram is cut off.

The model grows with the corpus, so it is never in one place. Documents form blocks of bounded
size. A block counts its distinct n-grams and sends them, sorted and packed, to partitions by hash; a
partition adds up the counts and answers every block in the order asked. From the answers a block
builds the part of the automaton that its texts can reach, and walks them through it, left to right.

Words are told apart by 64-bit hashes: among m distinct ones a mix-up has a chance of m^2 / 2^65.
Longer n-grams have numbers of 18 bits more than the corpus has bytes, so one in 2^18 or fewer
shares its number with another and may have a count that is too high. Order 3 and more, in place of
pairs, is what those shorter numbers pay for.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import groups_of, held_out, saved
from orderloom.llm.hashing import mix, word_hashes

END, START = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
ORDER, STRENGTH = 3, 20.0
# Bits of the number of an n-gram beyond those that count the corpus' bytes.
SPARE_BITS = 18
# Texts are walked side by side, longer ones in parts of so many tokens.
WALK = 2048
MB = 1 << 20


def _numbers(values: np.ndarray) -> bytes:
    """Whole numbers in the narrowest type, compressed."""
    top = int(values.max()) if len(values) else 0
    width = next(w for w in (1, 2, 4, 8) if top < 1 << (8 * w))
    return bytes([width]) + zlib.compress(values.astype(f"<u{width}").tobytes(), 1)


def _from_numbers(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data[1:]), f"<u{data[0]}").astype(np.int64)


def _keys(values: np.ndarray, shift: int = 0) -> bytes:
    """Sorted 64-bit keys, whose last ``shift`` bits are zero, as the first one and the differences:
    the low bytes, which look random, as they are, the two high ones compressed."""
    if not len(values):
        return b""
    values = values >> np.uint64(shift)
    steps = np.diff(values)
    top = int(steps.max()) if len(steps) else 0
    width = max(2, (top.bit_length() + 7) // 8)
    planes = steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    head = int(values[0]).to_bytes(8, "little") + bytes([width]) + len(steps).to_bytes(4, "little")
    return head + planes[: width - 2].tobytes() + zlib.compress(planes[width - 2 :].tobytes(), 1)


def _from_keys(data: bytes, shift: int = 0) -> np.ndarray:
    if not data:
        return np.zeros(0, np.uint64)
    width, n = data[8], int.from_bytes(data[9:13], "little")
    low = 13 + (width - 2) * n
    body = data[13:low] + zlib.decompress(data[low:])
    steps = np.zeros((n + 1, 8), np.uint8)
    steps[1:, :width] = np.frombuffer(body, np.uint8).reshape(width, n).T
    steps[0] = np.frombuffer(data, np.uint8, 8)
    return np.cumsum(steps.reshape(-1).view("<u8"), dtype=np.uint64) << np.uint64(shift)


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values and each value's place among them, in half of ``np.unique``'s memory."""
    by_value = np.argsort(values)
    values = values[by_value]
    first = np.ones(len(values), dtype=bool)
    first[1:] = values[1:] != values[:-1]
    place = np.empty(len(values), dtype=np.int32)
    place[by_value] = np.cumsum(first, dtype=np.int32) - 1
    return values[first], place


class _Block:
    """Tokens of a block's texts and its distinct n-grams of every length up to ``order``.

    ``grams[k]`` are the sorted numbers of the n-grams of k + 1 tokens, ``at[k]`` says for every
    token which of them ends there. Near the start of a text the longer ones do not exist; what
    ``at`` says there is never looked at.
    """

    def __init__(self, texts: list, order: int, shift: int):
        words, offsets = word_hashes(texts)
        self.sizes = np.diff(offsets) + 1
        stops = np.cumsum(self.sizes)
        self.starts = stops - self.sizes
        tokens = np.full(len(words) + len(texts), END, dtype=np.uint64)
        inside = np.ones(len(tokens), dtype=bool)
        inside[stops - 1] = False
        tokens[inside] = words
        del words, inside, texts
        # How many tokens of the text stand before a token.
        self.before = np.arange(len(tokens), dtype=np.int32)
        self.before -= np.repeat(self.starts.astype(np.int32), self.sizes)
        self.grams, self.at, self.valid = [], [], []
        number = tokens
        for k in range(order):
            if k:
                context = np.roll(number, 1)
                if k == 1:
                    context[self.starts] = START
                number = mix(mix(context + np.uint64(k)) + tokens)
            valid = self.before >= k - 1
            own = number[valid] if k > 1 else number
            if k:
                own = own >> np.uint64(shift) << np.uint64(shift)
            grams, place = _distinct(own)
            at = np.zeros(len(tokens), dtype=np.int32)
            at[valid] = place
            del own, place
            self.grams.append(grams)
            self.at.append(at)
            self.valid.append(valid)

    def counts(self, train: np.ndarray) -> list[np.ndarray]:
        weight = np.repeat(train, self.sizes).astype(float)
        return [
            np.bincount(at[valid], weight[valid], len(grams)).astype(np.int64)
            for grams, at, valid in zip(self.grams, self.at, self.valid, strict=True)
        ]


class Automaton:
    """The states and arcs that a block's texts can reach, from the totals of its n-grams.

    State 0 is the root, state 1 the start of a text; then come the n-grams of one token, of two, and
    so on, each known by its place among the block's. ``arcs[k]`` are the weights of the arcs that
    read the last token of an n-gram of k + 1 tokens in the state of its first k, ``fails[k]`` those
    of the failure arcs of states of k tokens; an n-gram without arc has NaN.
    """

    def __init__(self, block: _Block, totals: list[np.ndarray], n: int, v: int, strength: float):
        self.block, self.order = block, len(totals)
        self.arcs, self.fails = [], [np.zeros(1)]
        estimate = (totals[0] + 1.0) / (n + 1.0 * (v + 1))
        self.known = [t > 0 for t in totals]
        self.root = np.log10(estimate)
        self.arcs.append(self.root)
        # As many texts start as end.
        end = np.searchsorted(block.grams[0], END)
        self.texts = int(totals[0][end]) if len(block.grams[0]) else 0
        self.start_fails = np.log10(strength / (self.texts + strength))
        # Only the words' numbers are still needed.
        block.grams[1:] = [len(grams) for grams in block.grams[1:]]
        for k in range(1, self.order):
            # A place in the block where the n-gram ends tells its context and its shorter form.
            spot = np.zeros(block.grams[k], dtype=np.int32)
            where = np.flatnonzero(block.valid[k]).astype(np.int32)
            spot[block.at[k][where]] = where
            del where
            context = totals[k - 1][block.at[k - 1][spot - 1]] if len(spot) else totals[k]
            if k == 1:
                context = np.where(block.before[spot] == 0, self.texts, context)
            lower = estimate[block.at[k - 1][spot]]
            estimate = (totals[k] + strength * lower) / (context + strength)
            del spot, lower, context
            with np.errstate(divide="ignore"):
                self.arcs.append(np.where(self.known[k], np.log10(estimate), np.nan))
            self.fails.append(np.log10(strength / (totals[k - 1] + strength)))

    def read(self, place: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The weight of reading the tokens at ``place``, and how many tokens the next states have.

        Before it every text is in the state of its last ``length`` tokens. Where that state has no
        arc for the token, its failure arc is followed, down to the root, which reads every token.
        """
        block, length = self.block, length.copy()
        weight, after = np.zeros(len(place)), np.zeros(len(place), dtype=np.int64)
        left = np.arange(len(place))
        for k in range(self.order - 1, -1, -1):
            here = left[length[left] == k]
            if not len(here):
                continue
            token = place[here]
            arc = self.arcs[k][block.at[k][token]]
            fits = ~np.isnan(arc)
            read = here[fits]
            weight[read] += arc[fits]
            # The n-gram just read is a state, without its first token if it is as long as can be.
            after[read] = min(k + 1, self.order - 1) if k else self.known[0][block.at[0][place[read]]]
            if k:
                missed = here[~fits]
                token = place[missed]
                first = block.before[token] == 0
                fail = self.fails[k][block.at[k - 1][token - 1]]
                weight[missed] += np.where(first, self.start_fails, fail)
                length[missed] = k - 1
            left = left[length[left] < k]
        return weight, np.minimum(after, self.order - 1)

    def walk(self) -> np.ndarray:
        """The weight of every text, all of them walked side by side.

        A long text is walked in parts. A part begins ``order - 1`` tokens early at the root, whose
        weights do not count: after them it is in the state that the whole walk would have reached.
        """
        block, warm = self.block, self.order - 1
        parts = -(-block.sizes // WALK)
        text = np.repeat(np.arange(len(parts)), parts)
        index = np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)
        lead = np.minimum(warm, index * WALK)
        begin = block.starts[text] + index * WALK - lead
        stop = np.minimum(begin + lead + WALK, block.starts[text] + block.sizes[text])
        by_size = np.argsort(begin - stop, kind="stable")
        text, begin, stop, lead = (x[by_size] for x in (text, begin, stop, lead))
        sizes = stop - begin
        # Texts begin in the state of their start, which is one token long.
        state = np.where(block.before[begin] > 0, 0, min(1, warm))
        total = np.zeros(len(text))
        for step in range(int(sizes.max(initial=0))):
            active = int(np.searchsorted(-sizes, -step, side="left"))
            weight, state[:active] = self.read(begin[:active] + step, state[:active])
            total[:active] += weight if step >= warm else np.where(lead[:active] > step, 0, weight)
        return np.bincount(text, total, len(block.sizes))


def _cuts(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where each hash partition begins in sorted keys."""
    part = ((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    return np.searchsorted(part, np.arange(parts + 1, dtype=np.uint64))


def _ask(order: int, shift: int, parts: int):
    def ask(frame: pd.DataFrame) -> pd.DataFrame:
        block = _Block(frame["text"].tolist(), order, shift)
        counts = block.counts(~frame["held_out"].to_numpy(dtype=bool))
        cuts = [_cuts(grams, parts) for grams in block.grams]
        used = np.flatnonzero(np.any([np.diff(c) > 0 for c in cuts], axis=0))
        out = {"block": np.full(len(used), int(frame["block"].iloc[0])), "part": used}
        for k, (grams, count, cut) in enumerate(zip(block.grams, counts, cuts, strict=True)):
            ranges = [slice(cut[p], cut[p + 1]) for p in used]
            out[f"grams{k}"] = [_keys(grams[r], shift if k else 0) for r in ranges]
            out[f"counts{k}"] = [_numbers(count[r]) for r in ranges]
        return pd.DataFrame(out)

    return ask


def _answer(order: int, shift: int):
    """Totals of a partition's n-grams, for each block in the order asked."""

    def answer(frame: pd.DataFrame) -> pd.DataFrame:
        out = {"block": frame["block"].to_numpy(), "part": frame["part"].to_numpy()}
        for k in range(order):
            keys = [_from_keys(x, shift if k else 0) for x in frame[f"grams{k}"]]
            counts = np.concatenate([_from_numbers(c) for c in frame[f"counts{k}"]])
            ends = np.cumsum([len(x) for x in keys])[:-1]
            distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
            totals = np.bincount(place, counts, len(distinct)).astype(np.int64)
            out[f"counts{k}"] = [_numbers(t) for t in np.split(totals[place], ends)]
            if not k:
                for name, value in (("distinct", (totals > 0).sum()), ("tokens", totals.sum())):
                    out[name] = np.zeros(len(frame), dtype=np.int64)
                    out[name][0] = int(value)
        return pd.DataFrame(out)

    return answer


def _score(order: int, shift: int, strength: float, n: int, v: int):
    def score(docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        ids, held_out = docs["doc_id"], docs["held_out"]
        block = _Block(docs.pop("text").tolist(), order, shift)
        answers = answers.sort_values("part")
        totals = [
            np.concatenate([_from_numbers(x) for x in answers.pop(f"counts{k}")]) for k in range(order)
        ]
        automaton = Automaton(block, totals, n, v, strength)
        words = block.at[0]
        return pd.DataFrame(
            {
                "doc_id": ids,
                "held_out": held_out,
                "n_tokens": block.sizes,
                "n_known": np.add.reduceat((totals[0] > 0)[words].astype(np.int64), block.starts),
                "train_tokens": n,
                "base_score": np.add.reduceat(automaton.root[words], block.starts),
                "score": automaton.walk(),
            }
        )

    return score


def score_documents(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", modulus: int = 7,
    remainder: int = 2, order: int = ORDER, strength: float = STRENGTH,
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every document.

    ``order`` is the length of the longest n-grams, 1 or more. The model learns from documents whose
    id's crc32 does not have the remainder. A null text is an empty one: its only token is the end.
    Null ids train. Repeated rows each count and are each returned; an empty table gives no rows;
    other columns are ignored. Without training documents every probability is 1 at the root. The
    result depends on neither order nor partitioning, but for the last digits of the sums. A text is
    walked whole, however long.
    """
    if order < 1:
        raise ValueError("the longest n-grams have one token or more")
    spark = docs.sparkSession
    # Ids travel as text: a column of numbers with nulls would become floating point.
    texts = docs.select(
        F.col(id_col).cast("string").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        held_out(id_col, modulus, remainder).alias("held_out"),
    )
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shift = max(0, 64 - max(32, int(size).bit_length() + SPARE_BITS))
    blocks = groups_of(size, min(16 * MB, max(4 * MB, size // 256)))
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(64, 4 * shuffles, groups_of(size, 16 * MB))
    grouped = texts.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)))
    sent = ", ".join(f"grams{k} binary, counts{k} binary" for k in range(order))
    back = [f"counts{k}" for k in range(order)]
    asked = grouped.groupBy("block").applyInPandas(
        _ask(order, shift, parts), f"block long, part int, {sent}"
    )
    answers = saved(
        asked.groupBy("part").applyInPandas(
            _answer(order, shift),
            f"block long, part int, {', '.join(f'{c} binary' for c in back)}, distinct long, tokens long",
        ),
        "lm-counts",
    )
    v, n = answers.agg(F.sum("distinct"), F.sum("tokens")).first()
    return (
        grouped.groupBy("block")
        .cogroup(answers.select("block", "part", *back).groupBy("block"))
        .applyInPandas(
            _score(order, shift, strength, int(n or 0), int(v or 0)),
            "doc_id string, held_out boolean, n_tokens long, n_known long, train_tokens long, "
            "base_score double, score double",
        )
        .withColumn("doc_id", F.col("doc_id").cast("long"))
    )
