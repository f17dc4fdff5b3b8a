"""SentencePiece encoding and decoding by suffix-array matching.

A task concatenates the distinct units of a batch (runs that no piece reaches across), sorts all
their suffixes to the length of the longest piece, and finds every piece's occurrences as one range
by binary search. Occurrences are edges; sorted by the position where they end, they are relaxed
from left to right.

- **BPE models.** A node keeps the last piece of the encoding that ends there. An edge relaxes its
  end if its piece may follow the last piece of its start: merging both pieces' text gives just the
  two again. Neighbours that may all follow each other are the encoding, so exactly one edge fits.
  Which piece may follow which is kept in a table.
- **Unigram models.** An edge relaxes its end if it improves the sum of scores.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import islice, pairwise, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.common import named

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
SPACE_MARK = "▁"
START = -2
# Characters per batch text and per group of texts; units kept with their encoding in a task, and
# answers to which piece may follow which.
BATCH, GROUP, KEPT, FOLLOWS = 250_000, 1_000_000, 150_000, 400_000


@dataclass
class Vocabulary:
    """A model's pieces. ``pieces`` lists the text of all ids; ``ordinary`` the ids that match text."""

    pieces: list[str]
    scores: list[float]
    ordinary: list[int]
    byte_ids: list[int]
    unknown: int
    bpe: bool

    @classmethod
    def load(cls, path: str = VOCABULARY) -> Vocabulary:
        """Read a ``.model`` file (identity normalisation and a space put before the text)."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(model.get_piece_size())
        special = {
            i for i in every
            if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)
        }
        byte_ids = [i for i in every if model.is_byte(i)]
        return cls(
            [model.id_to_piece(i) for i in every],
            [model.get_score(i) for i in every],
            [i for i in every if i not in special],
            byte_ids,
            model.unk_id(),
            _model_type(model.serialized_model_proto()) == 2,
        )

    @cached_property
    def extra(self) -> list[str]:
        """Characters of pieces that are no piece themselves."""
        own = {self.pieces[i] for i in self.ordinary}
        return sorted({c for p in own for c in p} - own)

    @cached_property
    def texts(self) -> list[str]:
        """Text of each symbol: the ordinary pieces, then the extra characters."""
        return [self.pieces[i] for i in self.ordinary] + self.extra

    @cached_property
    def rank(self) -> dict[str, float]:
        return {self.pieces[i]: self.scores[i] for i in self.ordinary}

    @cached_property
    def matrix(self) -> tuple[np.ndarray, np.ndarray]:
        """Code points of all symbols, filled up with zeros, and their lengths."""
        lengths = np.array([len(t) for t in self.texts], dtype=np.int64)
        out = np.zeros((len(self.texts), int(lengths.max(initial=1))), dtype=np.int64)
        for k, text in enumerate(self.texts):
            out[k, : len(text)] = [ord(c) for c in text]
        return out, lengths

    @cached_property
    def units(self) -> re.Pattern:
        """Runs that no piece reaches across.

        Pieces have space marks in front only, if at all, and letters, digits and other characters
        do not meet inside a piece; where a vocabulary breaks one of these rules, units are larger.
        Control characters that no piece has are units of their own.
        """
        used = {c for t in self.texts for c in t}
        if any(SPACE_MARK in t.lstrip(SPACE_MARK) for t in self.texts):
            return re.compile(r".+", re.DOTALL)
        lone = "".join(re.escape(chr(c)) for c in range(32) if chr(c) not in used)
        # Signs like a raised 2 count as word characters in patterns, but are no letters.
        signs = "".join(c for c in sorted(used) if re.match(r"[^\W\d_]", c) and not c.isalpha())
        kinds = [f"[^\\W\\d_{signs}]+", r"\d+", f"(?:(?![{SPACE_MARK}{lone}])[\\W_{signs}])+"]
        one_kind = re.compile(f"{SPACE_MARK}*(?:{'|'.join(kinds)})|{SPACE_MARK}+")
        if not all(one_kind.fullmatch(t) for t in self.texts):
            kinds = [f"[^{SPACE_MARK}{lone}]+"]
        ends = [f"{SPACE_MARK}*{kind}" for kind in kinds] + [f"{SPACE_MARK}+"]
        return re.compile("|".join([f"[{lone}]"] * bool(lone) + ends))

    @cached_property
    def raw(self) -> list[bytes]:
        """What each id decodes to."""
        out = [p.replace(SPACE_MARK, " ").encode() for p in self.pieces]
        for value, i in enumerate(self.byte_ids):
            out[i] = bytes([value])
        for i in {*range(len(out))} - {*self.ordinary} - {*self.byte_ids}:
            out[i] = b""
        out[self.unknown] = " ⁇ ".encode()
        return out

    def merged(self, text: str) -> list[str]:
        """Merge the best neighbours again and again, the leftmost among equals."""
        parts, score, none = list(text), self.rank.get, float("-inf")
        scores = [score(a + b, none) for a, b in pairwise(parts)]
        while scores and (best := max(scores)) > none:
            at = scores.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del scores[at]
            if at:
                scores[at - 1] = score(parts[at - 1] + parts[at], none)
            if at < len(scores):
                scores[at] = score(parts[at] + parts[at + 1], none)
        return parts


def _model_type(data: bytes) -> int:
    """Type in the trainer's part of a model file (1: unigram, 2: BPE): field 3 of field 2."""

    def fields(part: bytes) -> Iterator[tuple[int, object]]:
        at = 0

        def number() -> int:
            nonlocal at
            value = shift = 0
            while True:
                byte = part[at]
                at += 1
                value |= (byte & 127) << shift
                shift += 7
                if byte < 128:
                    return value

        while at < len(part):
            tag = number()
            kind = tag & 7
            if kind == 0:
                yield tag >> 3, number()
            else:
                size = {1: 8, 5: 4}.get(kind) or number()
                yield tag >> 3, part[at : at + size]
                at += size

    for field, value in fields(data):
        if field == 2:
            return next((v for f, v in fields(value) if f == 3), 1)
    return 1


def suffix_ranks(codes: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order of their first ``depth`` codes, and their ranks.

    Each sort compares as many ranks of the sort before as fit into 62 bits.
    """

    def ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(keys)
        ordered = keys[order]
        rank = np.empty_like(keys)
        rank[order] = np.cumsum(np.concatenate(([1], ordered[1:] != ordered[:-1])))
        return order, rank

    order, rank = ranked(codes)
    length = 1
    while length < depth:
        bits = int(rank.max()).bit_length()
        keys, count = rank.copy(), max(2, 62 // bits)
        for k in range(length, count * length, length):
            keys <<= bits
            keys[:-k] |= rank[k:]
        order, rank = ranked(keys)
        length *= count
    return order, rank


def occurrences(
    codes: np.ndarray, suffixes: np.ndarray, symbols: np.ndarray, lengths: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The range of suffixes that begin with each symbol, by binary search of all at once.

    The first three codes, which fit into one number, give the ranges that longer symbols begin with.
    """
    symbols = np.pad(symbols, ((0, 0), (0, 3))).astype(np.int64)
    width = symbols.shape[1]
    padded = np.concatenate([codes, np.zeros(width, codes.dtype)]).astype(np.int64)
    heads = padded[:-2] << 42 | padded[1:-1] << 21 | padded[2:]
    least = symbols[:, 0] << 42 | symbols[:, 1] << 21 | symbols[:, 2]
    open_end = (1 << 21 * np.maximum(3 - lengths, 0)) - 1
    heads = heads[suffixes]
    low = np.searchsorted(heads, least, "left")
    high = np.searchsorted(heads, least | open_end, "right")
    longer = np.flatnonzero((lengths > 3) & (low < high))
    padded, columns = padded.astype(np.int32), np.arange(3, width)
    rest, outside = symbols[longer, 3:].astype(np.int32), columns >= lengths[longer, None]

    def search(after: bool) -> np.ndarray:
        bottom, top = low[longer], high[longer]
        while len(rows := np.flatnonzero(bottom < top)):
            middle = (bottom[rows] + top[rows]) // 2
            differ = padded[suffixes[middle][:, None] + columns] - rest[rows]
            differ[outside[rows]] = 0
            first = differ[np.arange(len(differ)), (differ != 0).argmax(axis=1)]
            goes_right = (first <= 0) if after else (first < 0)
            bottom[rows[goes_right]] = middle[goes_right] + 1
            top[rows[~goes_right]] = middle[~goes_right]
        return bottom

    low[longer], high[longer] = search(False), search(True)
    return low, high


class _Places(dict):
    """Codes of units; a unit that is new gets the next one."""

    def __missing__(self, unit: str) -> int:
        code = self[unit] = len(self)
        return code


class Encoder:
    """Encodes texts and keeps what it learned about units and neighbours while a task runs."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.follows: dict[int, bool] = {}
        self._forget()

    def _forget(self) -> None:
        self.place = _Places()
        self.flat = np.zeros(0, np.int32)
        self.sizes = np.zeros(0, np.int64)
        self.uses = np.zeros(0, np.int64)

    def _ids_of(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the units with these codes one after another, and how many each unit has."""
        count = self.sizes[codes]
        ends = np.cumsum(count)
        begins = (np.cumsum(self.sizes) - self.sizes)[codes]
        offset = np.arange(int(count.sum())) - np.repeat(ends - count, count)
        return self.flat[np.repeat(begins, count) + offset], count

    def _keep(self, codes: np.ndarray) -> None:
        """Forget all units but these."""
        names = list(self.place)
        self.uses = self.uses[codes] // 2
        self.flat, self.sizes = self._ids_of(codes)
        self.place = _Places((names[c], k) for k, c in enumerate(codes.tolist()))

    def _may_follow(self, keys: list[int]) -> np.ndarray:
        known = np.fromiter(map(self.follows.get, keys, repeat(2)), np.int8, len(keys))
        for k in np.flatnonzero(known == 2).tolist():
            known[k] = self.follows[keys[k]] = self._merges_apart(keys[k])
        return known.astype(bool)

    def _merges_apart(self, key: int) -> bool:
        v = self.vocabulary
        last, symbol = divmod(key, len(v.texts) + 1)
        last -= 1  # 0: the start of a unit; symbols count from 1
        text = v.texts[symbol - 1] if symbol else ""
        if last < 0:
            return not symbol or v.merged(text) == [text]
        before = v.texts[last]
        return not symbol or v.merged(before + text) == [before, text]

    def _possible(self, codes: np.ndarray) -> np.ndarray:
        """Symbols whose characters, and first two of them in this order, the batch text has."""
        symbols, lengths = self.vocabulary.matrix
        there = np.isin(symbols + 1, np.unique(codes))
        there |= np.arange(symbols.shape[1])[None, :] >= lengths[:, None]
        fits = there.all(axis=1)
        if symbols.shape[1] > 1:
            first = np.unique(codes[:-1] << 21 | codes[1:])
            fits &= (lengths < 2) | np.isin((symbols[:, 0] + 1) << 21 | (symbols[:, 1] + 1), first)
        return np.flatnonzero(fits)

    def _learn(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units that are new, taken as one batch text, and how many each unit has."""
        v = self.vocabulary
        if len(self.follows) > FOLLOWS:
            self.follows.clear()
        symbols, lengths = v.matrix
        lens = np.array([len(u) for u in units], dtype=np.int64)
        starts = np.concatenate(([0], np.cumsum(lens + 1)[:-1]))
        text = "\0".join(units) + "\0"
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        # Separators sort first and differ from a zero character of a text.
        codes = codes + 1
        codes[starts + lens] = 0
        suffixes, _ = suffix_ranks(codes, symbols.shape[1])
        possible = self._possible(codes)
        wanted = lengths[possible]
        shown = symbols[possible] + 1
        shown[np.arange(symbols.shape[1])[None, :] >= wanted[:, None]] = 0
        low, high = occurrences(codes, suffixes, shown, wanted)
        count = high - low
        symbol = np.repeat(possible.astype(np.int32), count)
        at = np.arange(len(symbol)) + np.repeat(low - (np.cumsum(count) - count), count)
        begin = suffixes.astype(np.int32)[at]
        del at, suffixes
        # A character that no symbol begins with and equals is an edge of its own, symbol -1.
        covered = np.zeros(len(codes), dtype=bool)
        lengths = lengths.astype(np.int32)
        span = lengths[symbol]
        covered[begin[span == 1]] = True
        alone = np.flatnonzero(~covered & (codes > 0)).astype(np.int32)
        span = np.concatenate([span, np.ones(len(alone), np.int32)])
        begin = np.concatenate([begin, alone])
        symbol = np.concatenate([symbol, np.full(len(alone), -1, np.int32)])
        end = begin + span
        unit_of = np.repeat(starts, lens + 1).astype(np.int32)
        depth = end - unit_of[begin]
        # Numpy sorts 16-bit numbers by their digits, which is much faster.
        short = np.uint16 if int(lens.max(initial=0)) < 1 << 16 else np.int32
        order = np.argsort(depth.astype(short), kind="stable")
        begin, symbol, end, depth = begin[order], symbol[order], end[order], depth[order]
        del order, span
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(depth)) + 1, [len(depth)]))
        last = np.full(len(codes) + 1, -1, dtype=np.int64)
        back = np.full(len(codes) + 1, -1, dtype=np.int64)
        if v.bpe:
            last[starts] = 0
            wide = len(v.texts) + 1
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                before = last[begin[a:b]]
                # Unknown characters merge with nothing; behind one a unit begins anew.
                keys = np.maximum(before, 0).astype(np.int64) * wide + symbol[a:b] + 1
                some, which = np.unique(keys, return_inverse=True)
                fits = self._may_follow(some.tolist())[which]
                fits &= before >= 0
                rows = np.flatnonzero(fits) + a
                last[end[rows]] = symbol[rows] + 1
                back[end[rows]] = begin[rows]
        else:
            own = np.array([v.rank.get(t, 0.0) for t in v.texts] + [min(v.scores) - 10.0])
            best = np.full(len(codes) + 1, -np.inf)
            best[starts] = 0
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                value = best[begin[a:b]] + own[symbol[a:b]]
                order = np.lexsort((-value, end[a:b]))
                firsts = np.unique(end[a:b][order], return_index=True)[1]
                rows = order[firsts] + a
                best[end[rows]] = value[order[firsts]]
                last[end[rows]] = symbol[rows] + 1
                back[end[rows]] = begin[rows]
        # Walk back from all units' ends at once.
        steps, node, active = [], starts + lens, np.flatnonzero(lens > 0)
        while len(active):
            at = node[active]
            steps.append((active, last[at], back[at]))
            node[active] = back[at]
            active = active[node[active] > starts[active]]
        which = np.concatenate([s[0] for s in steps])
        found = np.concatenate([s[1] for s in steps]) - 1
        where = np.concatenate([s[2] for s in steps])
        order = np.lexsort((where, which))
        which, found, where = which[order], found[order], where[order]
        ids = np.append(np.array(v.ordinary, dtype=np.int64), [-1] * (len(v.extra) + 1))[found]
        size = np.ones(len(ids), dtype=np.int64)
        odd = np.flatnonzero(ids < 0)
        if len(odd):
            # Characters without a piece become their bytes, or the unknown id.
            parts = [
                [v.byte_ids[x] for x in chr(codes[p] - 1).encode("utf-8", "surrogatepass")]
                if v.byte_ids else [v.unknown] for p in where[odd].tolist()
            ]
            size[odd] = [len(p) for p in parts]
            wide_ids = np.repeat(ids, size)
            wide_ids[np.repeat(ids < 0, size)] = [x for p in parts for x in p]
            which, ids = np.repeat(which, size), wide_ids
        return ids.astype(np.int32), np.bincount(which, minlength=len(units))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and where each text's ids begin."""
        find, place, known = self.vocabulary.units.findall, self.place, len(self.place)
        code = place.__getitem__
        parts = [np.zeros(0, np.int64)]
        for text in texts:
            units = find(SPACE_MARK + text.replace(" ", SPACE_MARK)) if text else []
            parts.append(np.fromiter(map(code, units), np.int64, len(units)))
        learnt, new, size = [(self.flat, self.sizes)], [], 0
        for unit in islice(place, known, None):
            new.append(unit)
            size += len(unit) + 1
            if size >= BATCH:
                learnt.append(self._learn(new))
                new, size = [], 0
        if new:
            learnt.append(self._learn(new))
        self.flat, self.sizes = map(np.concatenate, zip(*learnt, strict=True))
        codes = np.concatenate(parts)
        ids, count = self._ids_of(codes)
        bounds = np.cumsum([len(p) for p in parts])
        bounds = np.concatenate(([0], np.cumsum(count)))[bounds]
        uses = np.bincount(codes, minlength=len(place))
        uses[: len(self.uses)] += self.uses
        self.uses = uses
        if len(place) > KEPT:
            # Those used most, half as many as may be kept at most; one that came once is no use.
            most = np.argsort(-uses, kind="stable")[: KEPT // 2]
            self._keep(np.sort(most[uses[most] > 1]))
        return ids, bounds


_ENCODERS: dict[str, Encoder] = {}


def encoder_of(vocabulary: Vocabulary, name: str) -> Encoder:
    """One encoder per worker process: tasks that follow use what it learned."""
    if name not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[name] = Encoder(vocabulary)
    return _ENCODERS[name]


def decode(vocabulary: Vocabulary, ids: list[int]) -> str:
    """Text of ids: pieces joined, space marks as spaces, without the space put before the text."""
    raw = vocabulary.raw
    out = b"".join([raw[i] for i in ids]).decode("utf-8", "replace")
    return out[1:] if out.startswith(" ") else out


def encode_documents(
    docs: DataFrame, *, text_col: str = "text", vocabulary: str = VOCABULARY, out: str = "piece_ids"
) -> DataFrame:
    """All columns of ``docs`` with ``out`` (array of ids), ``n_pieces`` and ``round_trip``.

    ``round_trip`` says whether decoding gives the text again; it is false only where the text has
    the space mark itself, which decodes as a space. A null or empty text has no ids and round trip
    true. Null ids and repeated rows are rows like others, a text is taken whole however long it is,
    and an empty table gives no rows. Columns named like the results, in any case, are replaced. The vocabulary (bounded by its file) is read
    by the driver and sent to the tasks; rows are independent, so nothing is shuffled.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(Vocabulary.load(vocabulary))
    # Spark takes names that differ in case alone for one.
    results = {name.lower() for name in (out, "n_pieces", "round_trip")}
    kept = [f for f in docs.schema.fields if f.name.lower() not in results]
    names = [*[f.name for f in kept], out, "n_pieces", "round_trip"]
    # On the way the columns have plain names: Spark's Arrow functions take no others.
    plain = [f"c{k}" for k in range(len(names))]
    kinds = [f.dataType for f in kept]
    kinds += [T.ArrayType(T.IntegerType(), False), T.LongType(), T.BooleanType()]
    schema = T.StructType([T.StructField(*field) for field in zip(plain, kinds, strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        encoder = encoder_of(words, vocabulary)
        for batch in batches:
            whole = batch.column(at)
            # Texts are taken from the batch a group at a time.
            sizes = pc.fill_null(pc.binary_length(whole), 0).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // GROUP)) + 1
            for start, stop in zip([0, *cuts.tolist()], [*cuts.tolist(), len(whole)], strict=True):
                texts = whole.slice(start, stop - start).to_pylist()
                ids, bounds = encoder.encode(texts)
                same = [
                    decode(words, ids[a:b].tolist()) == (t or "")
                    for t, a, b in zip(texts, bounds[:-1], bounds[1:], strict=True)
                ]
                columns = [batch.column(k).slice(start, stop - start) for k in range(len(kept))]
                columns += [
                    pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32())),
                    pa.array(np.diff(bounds), pa.int64()),
                    pa.array(same, pa.bool_()),
                ]
                yield pa.RecordBatch.from_arrays(columns, plain)
            # The next batch is read before the loop lets go of this one.
            del batch, whole, columns

    # The text travels once, unless a result takes its place.
    given = [named(f.name).alias(name) for f, name in zip(kept, plain, strict=False)]
    at = next((k for k, f in enumerate(kept) if f.name == text_col), len(kept))
    if at == len(kept):
        given.append(named(text_col).alias("text"))
    return docs.select(*given).mapInArrow(run, schema).toDF(*names)


def decode_documents(
    docs: DataFrame, *, ids_col: str = "piece_ids", vocabulary: str = VOCABULARY, out: str = "text"
) -> DataFrame:
    """All columns of ``docs`` with ``out``: the text of the ids; null for null, empty for none.

    A column named like ``out`` is replaced; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(vocabulary))

    @F.pandas_udf("string")
    def text_of(ids: pd.Series) -> pd.Series:
        return ids.map(lambda x: None if x is None else decode(shared.value, x.tolist()))

    return docs.withColumn(out, text_of(F.col(ids_col)))
