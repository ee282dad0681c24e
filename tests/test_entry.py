import os
import shutil
import subprocess
import sys

import __spark_entry__
from halyard.plans import catalog

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_gives_rows(spark):
    out = __spark_entry__.entry(spark)
    assert out.count() > 0 and "wind_speed_ms" in out.columns


def test_every_oracle_has_its_query():
    assert set(catalog.oracle_sql()) <= set(catalog.queries()) and len(catalog.queries()) > 100


def test_the_rest_stands_without_the_optional_parts(tmp_path):
    shutil.copytree(f"{ROOT}/halyard", tmp_path / "halyard", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 100 and not any(k.startswith('op') for k in q) and 'pipeline' not in q; e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, check=True)
