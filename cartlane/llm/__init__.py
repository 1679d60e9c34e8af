"""Operators for training data: filters, deduplication, search, tokens and shards.

The functions that run in Python workers are shipped with their tasks, so workers need not
have this package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
