"""The driver's entry must import with no JVM, also when pyspark comes from its zip."""

import glob
import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
PROBE = "import __spark_entry__ as e, pyspark; print(pyspark.__file__); print(len(e.queries()) >= len(e.oracle_sql()) > 50)"


def _run(path):
    env = dict(os.environ, PYTHONPATH=os.pathsep.join(path))
    env.pop("SPARK_HOME", None)
    return subprocess.run([sys.executable, "-c", PROBE], cwd=REPO, env=env, capture_output=True, text=True, timeout=120)


def test_entry_imports_without_jvm():
    out = _run([REPO])
    assert out.returncode == 0, out.stderr[-2000:]
    assert out.stdout.split()[-1] == "True"


def test_entry_imports_from_zipped_pyspark():
    import pyspark
    lib = os.path.join(os.path.dirname(pyspark.__file__), "python", "lib")
    zips = sorted(glob.glob(os.path.join(lib, "*.zip")))
    if not zips:  # this installation carries no zips
        zips = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p.endswith(".zip")]
    if not zips:
        import pytest
        pytest.skip("no pyspark zip here")
    out = _run(zips + [REPO])
    assert out.returncode == 0, out.stderr[-2000:]
    assert "pyspark.zip" in out.stdout and out.stdout.split()[-1] == "True"
