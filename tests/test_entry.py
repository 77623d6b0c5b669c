"""The driver contract without the optional part."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = "import sys; sys.modules['ahocorasick'] = None; import __spark_entry__ as e; q = e.queries(); print(len(q), any(n.startswith('op1_') for n in q), set(e.oracle_sql()) <= set(q))"


def test_entry_survives_a_missing_library():
    done = subprocess.run([sys.executable, "-W", "always", "-c", CODE], cwd=ROOT, capture_output=True, text=True, timeout=120)
    number, optional, covered = done.stdout.split()
    assert int(number) > 100 and optional == "False" and covered == "True" and "left out" in done.stderr
