"""Operators for training-data pipelines: dedup, filters, scoring, tokens.

Nothing else in the library imports this package. Functions of this package
that run inside tasks are pickled by value, so executors need only the public
Python packages, not this repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
