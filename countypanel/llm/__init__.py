"""Operators for preparing training data: archives, privacy, quality, search, near-duplicates, packing and mixing.

Functions that run inside tasks are pickled by value, so that executors need no copy of
this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
