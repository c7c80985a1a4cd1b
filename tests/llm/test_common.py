import subprocess
import sys

import pytest

#: Arrays as tasks make them: one of 30 MB, after which glibc keeps blocks of that size
#: for itself, then some of 8 MB between small ones that stay.
HELD = """
import re
import numpy as np
from cohortkit.llm.common import lean

lean()

def held():
    return int(re.search(r"VmRSS:\\s+(\\d+)", open("/proc/self/status").read())[1]) / 1024

np.ones(30 << 17)
before, small = held(), []
large = []
for _ in range(12):
    large.append(np.ones(1 << 20))
    small.append(np.ones(1 << 12))
del large
print(held() - before)
"""


@pytest.mark.skipif(not sys.platform.startswith("linux"), reason="reads /proc")
def test_a_worker_gives_freed_memory_back():
    out = subprocess.run([sys.executable, "-c", HELD], capture_output=True, text=True, check=True).stdout
    assert float(out) < 20, "96 MB were used and freed"
