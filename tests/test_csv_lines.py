import random

import numpy as np
import pyarrow as pa
import pytest

from orderloom.sources.csv_lines import inside_before, join_lines, settle_splits, sum_up_splits


def naive(opens, stays, inside):
    out = [inside]
    for o, s in zip(opens, stays, strict=True):
        out.append(s if out[-1] else o)
    return out


@pytest.mark.parametrize("seed", range(5))
def test_states_as_step_by_step(seed):
    rng = np.random.default_rng(seed)
    for n in [0, 1, 2, 3, 50]:
        opens, stays = rng.random(n) < 0.5, rng.random(n) < 0.5
        for inside in (False, True):
            assert inside_before(opens, stays, inside).tolist() == naive(opens, stays, inside)


class Held:
    def __init__(self, value):
        self.value = value


@pytest.mark.parametrize("seed", range(30))
def test_files_cut_anywhere(seed):
    """Records of several files, cut into splits and batches at random lines."""
    rng = random.Random(seed)
    rows, expected = [], []
    for file in ("a", "b", "c"):
        lines, split = [("h", False, True)], 0
        for k in range(rng.randint(0, 25)):
            size = rng.choice([1, 1, 1, 2, 5])
            texts = [f"{file}{k}.{i}" for i in range(size)]
            expected.append("\n".join(texts))
            # Inside a record, a line without quotes keeps the state; the ends turn it.
            flags = [(False, True)] if size == 1 else [(True, False), *[(False, True)] * (size - 2), (True, False)]
            lines += [(t, *f) for t, f in zip(texts, flags, strict=True)]
        for line in lines:
            if rng.random() < 0.2 and rows and rows[-1]["path"] == file:
                split += rng.randint(1, 9)
            rows.append({"path": file, "split": split, "opens": line[1], "stays": line[2], "line": line[0]})

    def tasks():
        """Splits in order within a task, tasks of some splits each, in batches."""
        groups: dict = {}
        for row in rows:
            groups.setdefault((row["path"], row["split"]), []).append(row)
        held = list(groups.values())
        random.Random(seed).shuffle(held)
        while held:
            task = [row for group in held[:3] for row in group]
            held = held[3:]
            yield [pa.RecordBatch.from_pylist(task[k : k + 4]) for k in range(0, len(task), 4)]

    summary = [row for task in tasks() for batch in sum_up_splits(task) for row in batch.to_pylist()]
    join = join_lines(Held(settle_splits(summary)))
    found = [row for task in tasks() for batch in join(task) for row in batch.to_pylist()]
    whole = [row["record"] for row in found if row["path"] is None]
    pieces: dict = {}
    for row in sorted((r for r in found if r["path"] is not None), key=lambda r: r["split"]):
        pieces.setdefault((row["path"], row["begun_in"]), []).append(row["record"])
    assert sorted(whole + ["\n".join(p) for p in pieces.values()]) == sorted(expected)
    splits = {(row["path"], row["split"]) for row in rows}
    assert sum(map(len, pieces.values())) <= 2 * len(splits)


def test_a_file_that_ends_inside_quotes():
    summary = [{"path": "a", "split": 0, "opens": True, "stays": False, "begins": True, "begins_inside": False}]
    with pytest.raises(ValueError, match="without end in a"):
        settle_splits(summary)
