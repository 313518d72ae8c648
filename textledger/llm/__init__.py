"""Operators of a training-data pipeline, each a function from DataFrames to DataFrames.

Nothing else in the library imports this package. Functions that run in Python tasks
are sent by value, so executors need numpy, pyarrow, xxhash and regex but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
