"""Operators for building training corpora.

Nothing outside this package imports it. Python functions that run in tasks
are pickled by value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
