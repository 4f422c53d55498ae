"""The training-data operators can be removed without harm to the rest."""

import os
import shutil
import subprocess
import sys
import tempfile

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LIST = ("import sys, __spark_entry__ as e; "
        "print(len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries(), "
        "any(n.startswith('op') and n[2].isdigit() for n in e.queries()), "
        "'indicata.llm' in sys.modules)")


def _listed(folder, *code):
    run = subprocess.run([sys.executable, "-B", "-c", "\n".join([*code, LIST])], cwd=folder,
                         capture_output=True, text=True,
                         env={**os.environ, "PYTHONPATH": folder})
    assert run.returncode == 0, run.stderr
    return run.stdout.split()


def _copy(*left_out):
    folder = tempfile.mkdtemp(prefix="indicata-copy-")
    gone = {os.path.join(REPO, p) for p in left_out}
    for top in ("indicata", "__spark_entry__.py", "corpus_pipeline.py"):
        src, dst = os.path.join(REPO, top), os.path.join(folder, top)
        if os.path.isdir(src):
            shutil.copytree(src, dst, ignore=lambda d, names: [
                n for n in names if n == "__pycache__" or os.path.join(d, n) in gone])
        elif os.path.exists(src) and src not in gone:
            shutil.copy(src, dst)
    return folder


@pytest.mark.parametrize("left_out", [
    ("indicata/llm", "corpus_pipeline.py"), ("indicata/llm",)])
def test_report_queries_remain_without_the_operators(left_out):
    from indicata.plans import catalog
    got = _listed(_copy(*left_out))
    assert got == [str(len(catalog.QUERIES)), str(len(catalog.ORACLE)), "False", "False", "False"]


def test_report_queries_remain_without_a_tokenizer_library():
    from indicata.plans import catalog
    got = _listed(REPO, "import sys", "sys.modules['public_tokenizers'] = None")
    assert got[0] == str(len(catalog.QUERIES)) and got[2] == "False"


def test_nothing_else_imports_the_operators():
    for folder, _, names in os.walk(os.path.join(REPO, "indicata")):
        if os.path.basename(folder) != "llm":
            for name in names:
                if name.endswith(".py"):
                    with open(os.path.join(folder, name), encoding="utf-8") as f:
                        assert "indicata.llm" not in f.read(), name
