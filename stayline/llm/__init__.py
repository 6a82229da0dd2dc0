"""Operators of a training-data pipeline over documents, pages, labels and conversations."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so that a job needs no installed copy of it there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
