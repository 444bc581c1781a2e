"""The driver's entry with and without the part for training data."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent

HIDDEN = """
import re
import sys
for name in {names!r}:
    sys.modules[name] = None
import __spark_entry__ as entry
print(len([n for n in entry.queries() if re.match(r"op\\d", n) or n == "pipeline"]), len(entry.queries()) > 80,
      set(entry.oracle_sql()) <= set(entry.queries()))
"""


def found(*names):
    done = subprocess.run([sys.executable, "-c", HIDDEN.format(names=names)], cwd=ROOT, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    return done.stdout.split()


def test_a_missing_library_leaves_the_other_queries():
    assert found("xxhash") == ["0", "True", "True"]
    assert found("civicloom.llm") == ["0", "True", "True"]


def test_without_the_pipeline_the_operators_stay():
    whole, alone = found(), found("corpus_pipeline")
    assert whole[1:] == alone[1:] == ["True", "True"] and int(whole[0]) in (0, int(alone[0]) + 1)
