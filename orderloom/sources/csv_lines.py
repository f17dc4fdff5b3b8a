"""Lines to CSV records inside the task that reads them.

Per line it is known whether it ends inside quotes if it begins outside (``opens``) or inside
(``stays``). So a line either fixes the state (both the same), keeps it, or turns it; a run of lines
does one of these too, which is all that has to be known of it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def inside_before(opens: np.ndarray, stays: np.ndarray, inside: bool) -> np.ndarray:
    """Whether each line begins inside quotes, and last whether the line after would."""
    turns = np.concatenate(([0], np.cumsum(opens & ~stays)))
    fixed = np.concatenate(([-1], np.where(opens == stays, np.arange(len(opens)), -1)))
    last = np.maximum.accumulate(fixed)
    start = np.where(last >= 0, opens[last] if len(opens) else False, inside)
    return start ^ ((turns - turns[np.maximum(last, 0)] * (last >= 0)) % 2 == 1)


def runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, int, int]]:
    """Path, split, start and end of the lines of one split that follow each other."""
    if not batch.num_rows:
        return
    path, split = batch.column("path"), batch.column("split").to_numpy()
    other = pc.not_equal(path[1:], path[:-1]).to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero(other | (split[1:] != split[:-1])) + 1
    bounds = [0, *cuts.tolist(), batch.num_rows]
    for start, end in zip(bounds, bounds[1:], strict=False):
        yield path[start].as_py(), int(split[start]), start, end


def _flags(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(batch.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in ("opens", "stays"))


def sum_up_splits(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per split: how it ends, and whether a record begins in it, if it begins outside quotes
    (``opens``, ``begins``) and inside (``stays``, ``begins_inside``)."""
    rows, current = [], None
    for batch in batches:
        opens, stays = _flags(batch)
        for path, split, start, end in runs(batch):
            if current is None or (current["path"], current["split"]) != (path, split):
                current = {
                    "path": path, "split": split, "opens": False, "stays": True, "begins": False,
                    "begins_inside": False,
                }
                rows.append(current)
            for ends, begins in (("opens", "begins"), ("stays", "begins_inside")):
                states = inside_before(opens[start:end], stays[start:end], current[ends])
                current[begins] |= not states[:-1].all()
                current[ends] = bool(states[-1])
    if rows:
        yield pa.RecordBatch.from_pylist(rows)


def settle_splits(summary: list[dict]) -> dict[str, dict[int, int]]:
    """Per path, for every split that begins inside quotes: the split where that record began."""
    found: dict[str, dict[int, int]] = {}
    path, inside = None, False
    for row in sorted(summary, key=lambda r: (r["path"], r["split"])):
        if row["path"] != path:
            _check_closed(path, inside)
            path, inside, begun = row["path"], False, row["split"]
        if inside:
            found.setdefault(path, {})[row["split"]] = begun
        if row["begins_inside"] if inside else row["begins"]:
            begun = row["split"]
        inside = row["stays"] if inside else row["opens"]
    _check_closed(path, inside)
    return found


def _check_closed(path: str | None, inside: bool) -> None:
    if inside:
        raise ValueError(f"quoted field without end in {path}")


def _join(lines: list[pa.Array], bounds: np.ndarray) -> pa.Array:
    """The lines between two bounds each, joined."""
    flat = pa.concat_arrays(lines)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), flat), "\n")


def join_lines(begun_in):
    """Whole records (without path), and pieces of records that a split cuts, by where these began.

    ``begun_in`` is a broadcast result of ``settle_splits``. The first record of a file is left out.
    """

    def batch_of(texts: pa.Array, path=None, begun=None, split=None) -> pa.RecordBatch:
        n = len(texts)
        columns = [pa.array([v] * n, t) for v, t in ((path, pa.string()), (begun, pa.int64()), (split, pa.int64()))]
        return pa.RecordBatch.from_arrays([*columns, texts], ["path", "begun_in", "split", "record"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = split = None
        inside = first = False
        begun, waiting = None, []  # where the record of the waiting lines began

        def cut() -> Iterator[pa.RecordBatch]:
            """What waits at the end of a split: a record's last line, or a piece of one."""
            if waiting:
                text = _join(waiting, np.array([0, sum(map(len, waiting))]))
                is_piece = inside or begun != split
                if not first:
                    yield batch_of(text, path, begun, split) if is_piece else batch_of(text)

        for batch in batches:
            opens, stays = _flags(batch)
            lines = batch.column("line").cast(pa.string())
            for new_path, new_split, start, end in runs(batch):
                if (path, split) != (new_path, new_split):
                    yield from cut()
                    path, split, waiting = new_path, new_split, []
                    begun = begun_in.value.get(path, {}).get(split)
                    inside, first = begun is not None, split == 0
                states = inside_before(opens[start:end], stays[start:end], inside)
                inside = bool(states[-1])
                begins = np.flatnonzero(~states[:-1])
                part = lines.slice(start, end - start)
                if not len(begins):
                    waiting.append(part)
                    continue
                if begins[0]:
                    waiting.append(part.slice(0, begins[0]))
                if waiting and not first:
                    text = _join(waiting, np.array([0, sum(map(len, waiting))]))
                    yield batch_of(text) if begun == split else batch_of(text, path, begun, split)
                if len(begins) > 1:
                    whole = _join([part.slice(begins[0], begins[-1] - begins[0])], begins - begins[0])
                    skipped = int(first and not waiting)
                    yield batch_of(whole.slice(skipped))
                    first = False
                elif waiting:
                    first = False
                begun, waiting = split, [part.slice(begins[-1])]
        yield from cut()

    return run
