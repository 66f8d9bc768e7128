"""The rest of the library without the text operators."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def copied(folder, *without):
    keep = shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache")
    there = os.path.join(folder, "copy")
    shutil.copytree(ROOT, there, ignore=lambda base, names: {*keep(base, names), *(n for n in names if os.path.relpath(os.path.join(base, n), ROOT) in without)})
    return there


ASK = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"


def asked(there):
    done = subprocess.run([sys.executable, "-c", ASK], cwd=there, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": there})
    assert done.returncode == 0, done.stderr
    names, oracles = (line.split() for line in done.stdout.splitlines())
    return names, oracles


def test_entry_points_without_text_operators(tmp_path):
    from riskrules.plans.catalog import REGISTRY

    llm = os.path.join("riskrules", "llm")
    for i, gone in enumerate(((llm,), (llm, "corpus_pipeline.py"))):
        names, oracles = asked(copied(str(tmp_path / str(i)), *gone))
        assert names == sorted(REGISTRY) and set(oracles) <= set(names)


def test_core_does_not_import_text_operators():
    for base, _, files in os.walk(os.path.join(ROOT, "riskrules")):
        if os.path.basename(base) == "llm":
            continue
        for name in files:
            if name.endswith(".py"):
                with open(os.path.join(base, name)) as f:
                    assert "riskrules.llm" not in f.read(), name


def test_every_test_file_is_collected():
    """No two test files of one base name: the second would end the collection."""
    names = [n for _, _, files in os.walk(os.path.join(ROOT, "tests")) for n in files if n.startswith("test_") and n.endswith(".py")]
    assert len(names) == len(set(names))
