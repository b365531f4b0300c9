"""Operators for training corpora and the queries that apply them.

Python functions of this package are sent to the executors by value, so a
worker needs the installed libraries but not this repository on its path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
