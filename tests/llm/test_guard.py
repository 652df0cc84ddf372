import os
import shutil
import subprocess
import sys


def test_library_works_without_the_text_operators(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    copy = tmp_path / "repo"
    shutil.copytree(root, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert 'pipeline' not in q and not any(n.startswith('op') for n in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, env={**os.environ, "PYTHONPATH": str(copy)})


def test_nothing_else_imports_them():
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for folder, _, names in os.walk(os.path.join(root, "quakeframe")):
        if os.path.basename(folder) == "llm":
            continue
        for n in names:
            if n.endswith(".py"):
                assert "quakeframe.llm" not in open(os.path.join(folder, n), encoding="utf-8").read(), n
