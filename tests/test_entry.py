"""The entry points work with and without the folder of the training-data operators."""

import shutil
import subprocess
import sys

from conftest import ROOT


def test_entry_points_without_the_optional_folder(tmp_path):
    for name in ("creditloom", "__spark_entry__.py"):
        source = ROOT / name
        if source.is_dir():
            skip = shutil.ignore_patterns("llm", "__pycache__")
            shutil.copytree(source, tmp_path / name, ignore=skip)
        else:
            shutil.copy(source, tmp_path / name)
    code = "import __spark_entry__ as e; print(len(e.queries()), sorted(e.oracle_sql()) == sorted(e.queries()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    count, same = done.stdout.split()
    assert int(count) >= 78 and same == "True"
