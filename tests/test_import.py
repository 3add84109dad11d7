"""The entry module must import where Spark's install has no jars folder
next to the Python package (no file, jar or JVM access at import)."""

import os
import subprocess
import sys
import textwrap

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_imports_without_jars(tmp_path):
    import pyspark
    src = os.path.dirname(pyspark.__file__)
    dst = tmp_path / "pyspark"
    dst.mkdir()
    for name in os.listdir(src):
        if name != "jars":
            os.symlink(os.path.join(src, name), dst / name)
    code = textwrap.dedent("""
        import os, pyspark
        assert not os.path.exists(os.path.join(os.path.dirname(pyspark.__file__), "jars"))
        import __spark_entry__ as e
        assert len(e.queries()) >= 74 and len(e.oracle_sql()) >= 74
        print("ok")
    """)
    env = os.environ | {"PYTHONPATH": f"{tmp_path}:{REPO}"}
    env.pop("SPARK_HOME", None)
    r = subprocess.run([sys.executable, "-B", "-c", code], env=env, cwd=tmp_path, capture_output=True, text=True)
    assert r.returncode == 0 and "ok" in r.stdout, r.stderr[-2000:]
