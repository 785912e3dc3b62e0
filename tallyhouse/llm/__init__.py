"""Operators for training-data pipelines. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Code for Python workers travels with its task, so executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
