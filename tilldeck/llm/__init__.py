"""Operators for training-data preparation on documents, pages and embeddings."""

import os
import sys
from pathlib import Path

from pyspark import cloudpickle

# Where Python workers cannot import this package by its path, its functions
# travel with their tasks instead.
_root = Path(__file__).resolve().parents[2]
if _root not in {Path(p).resolve() for p in (os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep))}:
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
