"""The helpers of the other tests, also when only this folder is run."""

import pathlib
import sys

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))
