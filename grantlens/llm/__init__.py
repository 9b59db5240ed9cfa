"""Operators for preparing training text: decontamination, packing, scoring, filters, near duplicates, search, extraction.

Nothing else in the library imports this package. Functions that run in Python workers are pickled by
value, so that executors need no copy of the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
