"""What one Python worker holds over many short texts, normal ones and one very long one."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

# Prints by how many MB the peak grows while one Arrow batch is worked off.
PROBE = """
import resource, sys
import numpy as np, pyarrow as pa
from ledgerlens.llm import minhash, substrings, suffixes
texts, size = int(sys.argv[1]), int(sys.argv[2])
words = np.array([f"w{i * 7919 % 5003}" for i in range(5000)])
rng = np.random.default_rng(1)
rows = [" ".join(words[rng.integers(0, 5000, size // 6)].tolist()) for _ in range(texts)]
i = pa.array(range(texts), pa.int64())
batch = pa.RecordBatch.from_arrays([i, i, i, pa.array([1] * texts, pa.int64()), pa.array(rows)], names=["node", "k1", "k2", "copies", "text"])
del rows
peak = lambda: resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024
before = peak()
work = {"op2": substrings._emit(1, 35), "op4": suffixes._anchors_of(200), "op10": minhash._sign}[sys.argv[3]]
assert sum(b.num_rows for b in work(iter([batch]))) >= 0
print(peak() - before)
"""


@pytest.mark.parametrize("name", ["op2", "op4", "op10"])
@pytest.mark.parametrize("texts,size", [(10_000, 70), (2_000, 4_000), (1, 10_000_000)])
def test_a_worker_stays_small(name, texts, size):
    root = str(Path(__file__).resolve().parents[2])
    found = subprocess.run([sys.executable, "-c", PROBE, str(texts), str(size), name], cwd=root, capture_output=True, text=True, timeout=120)
    assert found.returncode == 0, found.stderr
    assert int(found.stdout) < 200
