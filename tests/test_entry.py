"""The entry imports with its core queries whatever the optional parts lack."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = "import __spark_entry__ as e; q = e.queries(); print(len(q), sum(k.startswith('op') or k == 'pipeline' for k in q), set(e.oracle_sql()) <= set(q))"


def counts(before=""):
    out = subprocess.run([sys.executable, "-c", before + COUNT], cwd=ROOT, capture_output=True, text=True, check=True).stdout.split()
    return int(out[0]), int(out[1]), out[2]


@pytest.mark.parametrize("module", ["ahocorasick", "xxhash", "botsieve.llm", "corpus_pipeline"])
def test_a_missing_package_leaves_the_core(module):
    everything, optional, _ = counts()
    there, left, fits = counts(f"import sys; sys.modules[{module!r}] = None; ")
    assert fits == "True" and there - left == everything - optional >= 58
    assert left == (max(0, optional - 1) if module == "corpus_pipeline" else 0)
