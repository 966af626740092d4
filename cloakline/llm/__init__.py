"""Operators for training-data pipelines (nothing else in the library imports this).

Functions that run inside tasks are pickled by value, so executors need no
installed copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
