"""Spark-native engine for building, auditing and curating question-answer training data."""

import sys

from pyspark import cloudpickle

# Functions travel to the Python workers by value: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
