"""The contract module works without the training-data operators."""

import os
import subprocess
import sys

BLOCKED = """
import sys

class Blocker:
    def find_spec(self, name, path=None, target=None):
        if name == BLOCK or name.startswith(BLOCK + "."):
            raise ModuleNotFoundError(f"No module named {name!r}", name=FAULT)

BLOCK, FAULT = sys.argv[1], sys.argv[2]
sys.meta_path.insert(0, Blocker())
import __spark_entry__ as entry
names = set(entry.queries())
print(len(names), any(n.startswith("op") and n[2].isdigit() for n in names), "pipeline" in names, set(entry.oracle_sql()) <= names)
"""


def run(block, fault):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    return subprocess.run([sys.executable, "-c", BLOCKED, block, fault], cwd=root, capture_output=True, text=True, check=False)


def test_without_the_subpackage():
    done = run("cotrend.llm", "cotrend.llm")
    assert done.stdout.split()[1:] == ["False", "False", "True"], done.stderr
    assert int(done.stdout.split()[0]) > 30


def test_without_the_pipeline():
    done = run("corpus_pipeline", "corpus_pipeline")
    assert done.stdout.split()[2:] == ["False", "True"], done.stderr


def test_a_fault_inside_is_an_error():
    done = run("cotrend.llm", "some_library")
    assert done.returncode and "some_library" in done.stderr or "ModuleNotFoundError" in done.stderr
