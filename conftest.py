"""Puts the repository on the path of tests."""

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))
