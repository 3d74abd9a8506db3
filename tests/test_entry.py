import os
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = """
import sys

class Missing:
    def find_spec(self, name, path=None, target=None):
        if name in sys.argv[1:]:
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)

sys.meta_path.insert(0, Missing())
import __spark_entry__ as entry
names = entry.queries()
assert "build_dataset" in names and entry.oracle_sql().keys() <= names.keys()
assert not [n for n in names if n == "pipeline" or n[:2] == "op" and n[2].isdigit()]
"""


@pytest.mark.parametrize(
    "missing", ["quizloom.llm", "corpus_pipeline", "ahocorasick", "xxhash", "zstandard"]
)
def test_library_queries_need_nothing_of_the_training_data_operators(missing):
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT, missing], cwd=REPO, capture_output=True, text=True, timeout=120
    )
    assert done.returncode == 0, done.stderr
