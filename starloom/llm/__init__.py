"""Operators that prepare text for the training of language models.

Functions that run in Python workers travel by value, so that executors need no copy of
this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
