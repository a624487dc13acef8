"""Operators over text corpora for training data: deduplication, decontamination, quality, privacy, packing."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with their code, so these need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
