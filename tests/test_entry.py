import os
import shutil
import subprocess
import sys

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SAY = "import __spark_entry__ as e; q = e.queries(); print(len(q), sum(n[:2] == 'op' or n == 'pipeline' for n in q), set(e.oracle_sql()) <= set(q))"


def test_the_entry_imports_without_the_training_operators(tmp_path):
    """With their folder gone, with the pipeline left behind, and with a module that they need missing."""
    copy = tmp_path / "copy"
    shutil.copytree(HERE, copy, ignore=lambda d, names: [n for n in names if n in (".git", "llm", "__pycache__")])
    said = [subprocess.run([sys.executable, "-c", SAY], cwd=copy, env={**os.environ, "PYTHONPATH": str(copy)}, capture_output=True, text=True, check=True).stdout]
    (copy / "corpus_pipeline.py").unlink(missing_ok=True)
    said.append(subprocess.run([sys.executable, "-c", SAY], cwd=copy, env={**os.environ, "PYTHONPATH": str(copy)}, capture_output=True, text=True, check=True).stdout)
    assert said[0] == said[1] and said[0].split()[1:] == ["0", "True"] and int(said[0].split()[0]) > 130
    blocked = "import sys; sys.modules['xxhash'] = None; " + SAY
    out = subprocess.run([sys.executable, "-c", blocked], cwd=HERE, env={**os.environ, "PYTHONPATH": HERE}, capture_output=True, text=True, check=True).stdout
    assert int(out.split()[0]) >= int(said[0].split()[0])
