"""Operators on text corpora: extraction, filters, deduplication, mixing and scoring for training data.

Functions that run in tasks are pickled by value, so executors need only numpy, pyarrow and xxhash, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
