"""Operators for building language-model training data, and the queries that apply them.

Their per-batch Python helpers are pickled by value, so executors need not have this package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
