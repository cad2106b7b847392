"""Folders that the tests use (an ordinary module: ``conftest`` is the name of several files)."""

import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
