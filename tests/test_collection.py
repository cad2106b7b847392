"""Every test module can be collected, whatever other folders of tests are there."""

import os
import subprocess
import sys

import pytest
from paths import ROOT


@pytest.mark.parametrize("extra", [[], ["--ignore", os.path.join(ROOT, "tests", "llm")]])
def test_all_modules_are_collected(extra):
    run = subprocess.run([sys.executable, "-m", "pytest", "--collect-only", "-q", "-p", "no:cacheprovider", os.path.join(ROOT, "tests"), *extra],
                         cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stdout[-2000:]
    assert "error" not in run.stdout.lower().rsplit("\n", 2)[-2]
