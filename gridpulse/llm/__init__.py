"""Operators of a training-data pipeline.  Nothing outside this folder imports it.

Functions of this folder travel to the executors by value, so it need not be installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
