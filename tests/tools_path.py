"""Test helper: the compare digest of tools/check_oracle.py."""
import os
import sys

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check_oracle import digest as _digest  # noqa: E402


def digest(cols, rows):
    return _digest(cols, rows)[0], sorted(cols)
