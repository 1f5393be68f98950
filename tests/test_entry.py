"""The driver's contract, and that the core does without the optional subpackage."""

import pathlib
import subprocess
import sys

import __spark_entry__ as entry

ROOT = pathlib.Path(__file__).resolve().parents[1]


def test_contract():
    queries, oracles = entry.queries(), entry.oracle_sql()
    assert "clean_dedup" in queries and set(oracles) <= set(queries)


def test_core_imports_nothing_of_the_subpackage():
    code = (
        "import sys, pathlib, importlib\n"
        "for p in sorted(pathlib.Path('granary').rglob('*.py')):\n"
        "    name = '.'.join(p.with_suffix('').parts).removesuffix('.__init__')\n"
        "    if '.llm' not in name: importlib.import_module(name)\n"
        "assert not [m for m in sys.modules if m.startswith('granary.llm')]"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
