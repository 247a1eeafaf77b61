"""The exact bootstrap against plain Python, and its hashes against hashlib."""

import hashlib

import numpy as np
import pytest

from notelab.functions import md5
from notelab.operators import evaluation as ev


def plain(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16)


def test_hashes_of_numbered_texts():
    for prefix in ("", "42_7_", "x" * 50):
        assert md5.numbered(prefix.encode(), 0, 1200).tolist() == [plain(f"{prefix}{i}") for i in range(1201)]
    assert md5.numbered(b"42_", 99_998, 100_003).tolist() == [plain(f"42_{i}") for i in range(99_998, 100_004)]
    assert md5.numbered(b"a", 5, 4).tolist() == []
    with pytest.raises(ValueError):
        md5.numbered(b"x" * 55, 0, 0)


def test_exact_bootstrap_against_plain(spark, monkeypatch):
    monkeypatch.setattr(ev, "SLOTS", 16)  # blocks that end inside a power of ten, and a short last one
    labels = ["TP"] * 61 + ["FP"] * 23 + ["FN"] * 17 + [None] * 3
    table = spark.createDataFrame([(x,) for x in labels], "outcome string")
    got = {r.metric: r for r in ev.bootstrap_exact(table, 30).collect()}
    drawn = []
    for b in range(30):
        idx = [plain(f"42_{b}_{i}") % 101 for i in range(101)]
        tp, fp = sum(x < 61 for x in idx), sum(61 <= x < 84 for x in idx)
        p, r = tp / (tp + fp), tp / (tp + 101 - tp - fp)
        drawn.append((p, r, 2 * p * r / (p + r)))
    for k, metric in enumerate(("precision", "recall", "f1")):
        v = np.array([d[k] for d in drawn])
        assert np.allclose([got[metric]["mean"], got[metric].p025, got[metric].p975],
                           [v.mean(), np.quantile(v, 0.025), np.quantile(v, 0.975)], atol=2e-6)
    assert ev.bootstrap_exact(table.limit(0), 5).count() == 0
