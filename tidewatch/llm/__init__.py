"""Operators of a training-data pipeline over documents, pages and embeddings."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so that a session needs no copy of
# it there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
