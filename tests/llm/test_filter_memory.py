"""What a worker holds while it builds a filter of all the entries it gathers at once."""

from __future__ import annotations

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCRIPT = """
import resource
import numpy as np
from rillstone.llm import collocations as c
peak = lambda: resource.getrusage(resource.RUSAGE_SELF).ru_maxrss >> 10
before, pick = peak(), np.random.default_rng(1)
held = [c.permuted([pick.integers(1, 1 << 20, 50_000, dtype=np.uint64) for _ in range(4)]) for _ in range(c.HELD_ENTRIES // 50_000)]
columns = [np.concatenate(same) for same in zip(*held)]
held.clear()
for _, part in c.QuotientFilter.of(columns, np.ones(len(columns[0]), np.int64)).slices(8):
    part.to_bytes()
print(peak() - before)
"""


def test_a_gathered_filter_takes_little_memory():
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=REPO, capture_output=True, text=True, check=True, timeout=120)
    assert int(done.stdout) < 250  # MB
