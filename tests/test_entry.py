"""A library that only the training-data operators need costs their queries alone."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
CODE = """
import sys
sys.modules["{gone}"] = None
import __spark_entry__ as e
names = set(e.queries())
assert "pool_report" in names and len(names) > 70
assert not any(n.startswith("op1") for n in names), names
assert set(e.oracle_sql()) <= names
"""


def test_entry_without_a_library():
    for gone in ("ahocorasick", "tokenizers", "crawlfold.llm"):
        subprocess.run([sys.executable, "-W", "ignore", "-c", CODE.format(gone=gone)], cwd=ROOT, check=True, timeout=120)
