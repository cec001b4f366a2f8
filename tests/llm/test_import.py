import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).parents[2]
WITHOUT = """
import sys, warnings

class Absent:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] == {name!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)

sys.meta_path.insert(0, Absent())
warnings.simplefilter("ignore")
import __spark_entry__
print(len(__spark_entry__.queries()), sum(n.startswith("op") for n in __spark_entry__.queries()), "pipeline" in __spark_entry__.queries())
"""


def test_entry_without_a_library():
    for name in ("xxhash", "corpus_pipeline"):
        out = subprocess.run([sys.executable, "-c", WITHOUT.format(name=name)], cwd=ROOT, capture_output=True, text=True, check=True)
        count, corpus, pipeline = out.stdout.split()
        assert int(count) > 50 and corpus == "0" and pipeline == "False"
