"""Ops 3 and 8: the network and the kernel regression against plain Python loops."""

import math

import numpy as np
import pyarrow as pa

from wearline.llm.language_id import DIM, FILTERS, WIDTHS, WINDOW, ByteNet
from wearline.llm.quality_classifier import FEATURES, Kernel, _equations, isotonic


def looped(net, window):
    """Probabilities of one window: every filter at every place, the largest, a rectifier, a softmax."""
    top = []
    for w in WIDTHS:
        for f in range(FILTERS):
            best = -math.inf
            for at in range(WINDOW - w + 1):
                total = 0.0
                for j in range(w):
                    for k in range(DIM):
                        total += float(net.p["e"][window[at + j]][k]) * float(net.p[f"w{w}"][j * DIM + k][f])
                best = max(best, total)
            top.append(max(best + float(net.p[f"b{w}"][f]), 0.0))
    z = [sum(t * float(net.p["u"][i][c]) for i, t in enumerate(top)) + float(net.p["c"][c]) for c in range(len(net.p["c"]))]
    e = [math.exp(v - max(z)) for v in z]
    return [v / sum(e) for v in e]


def test_network_equals_loops():
    net = ByteNet(["a", "b", "c"])
    rng = np.random.default_rng(2)
    for k in net.p:
        net.p[k] = net.p[k] + rng.normal(0, 0.2, net.p[k].shape).astype(net.p[k].dtype)
    x = rng.integers(0, 256, (2, WINDOW)).astype(np.uint8)
    got = net.probabilities(x)
    for window, row in zip(x, got, strict=True):
        assert np.allclose(looped(net, window), row, atol=1e-4)


class Held:
    def __init__(self, value):
        self.value = value


def test_kernel_and_equations_equal_loops():
    rng = np.random.default_rng(1)
    x, y = rng.normal(3, 2, (60, 9)), rng.integers(0, 2, 60).astype(float)
    kernel = Kernel(x.mean(axis=0), x.std(axis=0))
    for row, got in zip(x[:3], kernel.features(x[:3]), strict=True):
        unit = [max(-8.0, min(8.0, (v - m) / s)) for v, m, s in zip(row, kernel.mean, kernel.sd, strict=True)]
        want = [math.sqrt(2 / FEATURES) * math.cos(sum(u * kernel.w[i][f] for i, u in enumerate(unit)) + kernel.b[f]) for f in range(FEATURES)]
        assert np.allclose(got, want)

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(x[rows].tolist(), pa.list_(pa.float64())), pa.array(y[rows])], ["x", "y"])

    parts = [[batch(slice(0, 7)), batch(slice(7, 20))], [batch(slice(20, 60))], []]
    a = sum(np.frombuffer(out.column(0)[0].as_py()).reshape(FEATURES + 1, FEATURES + 2)
            for p in parts for out in _equations(Held(kernel))(iter(p)))
    z = np.column_stack([kernel.features(x), np.ones(60)])
    dense = np.column_stack([sum(np.outer(r, r) for r in z), sum(r * t for r, t in zip(z, y, strict=True))])
    assert np.allclose(a, dense)


def test_isotonic_is_the_closest_rising_fit():
    rng = np.random.default_rng(4)
    for _ in range(20):
        score = rng.permutation(12).astype(float)
        y = rng.integers(0, 2, 12)
        at, value = isotonic(score, y)
        order = np.argsort(score)
        s, t = score[order], y[order].astype(float)
        # max over starts of the min over ends of the block means
        want = [max(min(t[a:b + 1].mean() for b in range(i, 12)) for a in range(i + 1)) for i in range(12)]
        assert np.all(np.diff(value) > 0)
        blocks = [v for i, v in enumerate(want) if i == 0 or abs(v - want[i - 1]) > 1e-12]
        assert np.allclose(value, blocks)
        assert np.allclose(at, [s[np.isclose(want, v)].mean() for v in blocks])
