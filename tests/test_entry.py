import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry


def test_every_query_with_sql_is_registered(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.catalogue.queries()) >= 34
    assert entry.entry(spark).columns[0] == "aggregation_level"


def test_the_rest_stands_without_the_subpackage(tmp_path):
    """A copy without the language-model folders still imports and lists its queries."""
    root = Path(entry.__file__).parent
    code = "import sys; sys.modules['tidemark.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; print(len(e.queries()), any(k.startswith('op') for k in e.queries()))"
    got = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True).stdout.split()
    assert int(got[0]) >= 34 and got[1] == "False"
