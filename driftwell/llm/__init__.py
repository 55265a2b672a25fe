"""Operators that prepare text corpora for training. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# functions travel to executors with their code, so that these need not have the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
