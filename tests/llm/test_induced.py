import random

import numpy as np
import pytest

from sensorlake.llm import induced as ind


def brute(parts, cap):
    whole = [(p[i:], k, i) for k, p in enumerate(parts) for i in range(len(p))]
    return sorted(whole, key=lambda x: (x[0], x[1]), reverse=True)


def lcp(a, b, cap):
    n = 0
    while n < min(len(a), len(b), cap) and a[n] == b[n]:
        n += 1
    return n


@pytest.mark.parametrize("seed", range(60))
def test_order_and_common_prefixes(seed, tmp_path):
    rng = random.Random(seed)
    letters = b"ab" if seed % 3 else b"abcdefgh \xff\x00"
    base = bytes(rng.choice(letters) for _ in range(rng.randrange(1, 40)))
    parts = []
    for _ in range(rng.randrange(1, 12)):
        p = bytearray(base if rng.random() < 0.6 else bytes(rng.choice(letters) for _ in range(rng.randrange(1, 60))))
        if rng.random() < 0.5:
            p[rng.randrange(len(p))] = rng.choice(letters)
        parts.append(bytes(p))
    if seed % 5 == 0:
        parts += [b"a" * 50, b"a" * 30, b"a" * 50]
    cap = rng.choice([3, 10, 200])
    kw = {"folder": str(tmp_path), "limit": 8} if seed % 2 else {}
    runs = list(ind.sorted_runs(parts, cap, **kw))
    at, low = np.concatenate([a for a, _ in runs]), np.concatenate([b for _, b in runs])
    begin = np.concatenate(([0], np.cumsum([len(p) + 1 for p in parts])))
    k = np.searchsorted(begin, at, "right") - 1
    got = [parts[x][y:] for x, y in zip(k, at - begin[k], strict=True)]
    assert got == [x for x, _, _ in brute(parts, cap)]
    assert low.tolist() == [0, *[lcp(a, b, cap) for a, b in zip(got, got[1:])]]
    assert not list(tmp_path.iterdir())


def test_recursion_on_few_names():
    rng = random.Random(1)
    t = np.array([rng.choice((1, 2)) for _ in range(5000)] + [0], np.int64)
    got = ind.suffixes(ind.Shard(t, 3))
    s = bytes(t.astype(np.uint8))
    assert got.tolist() == sorted(range(len(s)), key=lambda i: s[i:])


def test_queue_spills_and_reads_back(tmp_path):
    q = ind.BucketQueue(3, limit=4, folder=str(tmp_path))
    for i in range(6):
        q.push(i % 2, np.arange(i, i + 3), np.full(3, i))
    assert q.spilled == 5
    a, b = q.pop(0)
    assert a.tolist() == [0, 1, 2, 2, 3, 4, 4, 5, 6] and b.tolist() == [0] * 3 + [2] * 3 + [4] * 3
    assert q.pop(2) is None
