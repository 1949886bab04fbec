"""Operators for building training corpora; nothing outside this folder and ``corpus_pipeline.py`` uses them."""

import sys

from pyspark import cloudpickle

# Functions of this folder are sent to the executors whole, so the package needs no installation there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
