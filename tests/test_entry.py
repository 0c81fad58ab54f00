"""The registered queries as a set: what they need, and that one does not disturb another."""

import os
import pathlib
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from tests.records import tuples, unordered

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
HERE = pathlib.Path(__file__).resolve().parent.parent

WITHOUT = """
import sys, warnings

class Missing:
    def find_spec(self, name, path=None, target=None):
        if name == {name!r}:
            raise ModuleNotFoundError("No module named " + repr(name), name=name)

sys.meta_path.insert(0, Missing())
with warnings.catch_warnings(record=True) as said:
    warnings.simplefilter("always")
    import __spark_entry__ as entry
names = entry.queries()
assert set(names) == set(entry.oracle_sql()), set(names) ^ set(entry.oracle_sql())
print(len(names), sum(n.startswith("op") or n == "pipeline" for n in names), len(said))
"""


@pytest.mark.parametrize("name, told", [("public_tokenizers", 1), ("repopulse.llm", 0), ("corpus_pipeline", 0)])
def test_the_core_queries_need_no_text_operators(name, told):
    done = subprocess.run(
        [sys.executable, "-c", WITHOUT.format(name=name)], cwd=HERE, capture_output=True, text=True, timeout=120
    )
    assert done.returncode == 0, done.stderr
    core = [n for n in entry.queries() if n != "pipeline" and not n.startswith("op")]
    if not (HERE / "repopulse" / "llm").is_dir():
        told = 0
    assert done.stdout.split() == [str(len(core)), "0", str(told)]


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")
def test_queries_that_store_something_can_be_built_first_and_read_later(spark):
    names = [n for n in entry.queries() if n.startswith(("published_", "landed_json_users", "stored_", "staging_view", "dq_unread"))]
    names += ["landed_json_users", "published_time_series"]
    built = [(name, entry.queries()[name](spark, SF_DIR)) for name in names]
    first = {name: unordered(tuples(df)) for name, df in built}
    for name, df in reversed(built):
        assert unordered(tuples(df)) == first[name] != []
