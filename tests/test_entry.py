"""The entry module without its optional part."""

import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from siftgate.checks.registry import CHECKS

ROOT = os.path.dirname(os.path.abspath(entry.__file__))
WITHOUT = """
import sys
for name in sys.argv[1:]:
    sys.modules[name] = None
import __spark_entry__ as entry
print(" ".join(entry.queries()))
"""


@pytest.mark.parametrize("missing", [["zstandard"], ["xxhash"], ["tiktoken", "sentencepiece"], ["siftgate.llm", "corpus_pipeline"]])
def test_library_queries_need_no_optional_module(missing):
    done = subprocess.run([sys.executable, "-c", WITHOUT, *missing], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert set(CHECKS) <= set(done.stdout.split())
    assert set(CHECKS) <= set(entry.queries())
