"""Operators of a training-data pipeline; nothing else in the library imports them.

Functions sent to executors are pickled by value, so a cluster's workers need not have
this package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
