"""Operators for training-data pipelines.

Functions that run inside Python tasks are sent by value, so executors need numpy and
pyarrow but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
