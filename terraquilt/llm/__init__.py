"""Operators for preparing training text: extraction, filters, near duplicates, mixing, shards, packing."""

import sys

from pyspark import cloudpickle

# the code goes with its tasks, so that executors need not have it installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
