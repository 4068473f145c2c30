import random

import numpy as np

from lamplight.llm import alignment


def plain(x, y):
    row = list(range(len(y) + 1))
    for i, a in enumerate(x, 1):
        before, row = row, [i]
        for j, b in enumerate(y, 1):
            row.append(min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (a != b)))
    return row[-1]


def pairs(n, seed):
    rng = random.Random(seed)
    for _ in range(n):
        x = [rng.randrange(4) for _ in range(rng.randrange(25))]
        y = list(x)
        for _ in range(rng.randrange(9)):
            if rng.random() < 0.5 and y:
                y.pop(rng.randrange(len(y)))
            else:
                y.insert(rng.randrange(len(y) + 1), rng.randrange(4))
        yield x, y if rng.random() < 0.8 else [rng.randrange(4) for _ in range(rng.randrange(25))]


def test_equals_the_plain_recurrence(monkeypatch):
    xs, ys = zip(*pairs(400, 1), strict=True)
    flat = lambda some: (np.array([v for s in some for v in s], np.int64), np.cumsum([0, *map(len, some)]))
    x, fx = flat(xs)
    y, fy = flat(ys)
    for most in (0, 1, 3, 6):
        want = [min(plain(a, b), most + 1) for a, b in zip(xs, ys, strict=True)]
        assert alignment.banded_distances(x, fx, y, fy, most).tolist() == want
        assert alignment.aligned(x, fx, y, fy, most, items=50).tolist() == want
        with monkeypatch.context() as m:
            m.setattr(alignment, "LONG", 12)  # some go one by one
            assert alignment.aligned(x, fx, y, fy, most).tolist() == want


def test_very_long_sequences():
    x = np.arange(3_000_000)
    y = np.concatenate([x[:1000], [-1, -2], x[1000:2_000_000], x[2_000_003:]])
    assert alignment.aligned(x, np.array([0, len(x)]), y, np.array([0, len(y)]), 8).tolist() == [5]


def test_no_pairs():
    none = np.empty(0, np.int64)
    assert alignment.aligned(none, np.array([0]), none, np.array([0]), 4).tolist() == []
    assert alignment.aligned(none, np.array([0, 0]), none, np.array([0, 0]), 4).tolist() == [0]
