"""The suite collects as one command: helpers have names of their own."""

import glob
import os
import re

from core_helpers import ROOT


def test_nothing_imports_from_a_conftest():
    files = glob.glob(os.path.join(ROOT, "tests", "**", "*.py"), recursive=True)
    assert files
    for path in files:
        with open(path) as f:
            assert not re.search(r"^\s*(from|import) conftest\b", f.read(), re.M), path


def test_module_names_are_unique():
    files = glob.glob(os.path.join(ROOT, "tests", "**", "*.py"), recursive=True)
    names = [os.path.basename(f) for f in files if os.path.basename(f) not in ("conftest.py", "__init__.py")]
    assert len(names) == len(set(names))
