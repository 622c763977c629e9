"""The other tests run without code generation; here a part of the queries runs as a user runs them."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
SF = Path("/root/testdata/sf0.001")


@pytest.mark.skipif(not SF.exists(), reason="no test tables")
def test_queries_with_code_generation():
    names = ["c1_", "c2_", "c5_", "c10_", "j1_", "r4_", "w1_", "w2_", "w6_", "g1_", "f12_", "k4_"]
    done = subprocess.run([sys.executable, "tools/check.py", "--sf", str(SF), *names], cwd=ROOT, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stdout[-3000:]
    assert done.stdout.rstrip().endswith("0 bad")
