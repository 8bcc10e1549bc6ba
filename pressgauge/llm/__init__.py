"""Operators for large text corpora: filters, near-duplicate joins, fingerprints, archives, formatting, mixing."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors whole, so these need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
