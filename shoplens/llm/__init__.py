"""Operators for preparing language-model training data (nothing else in the library imports this).

Their functions travel to the executors by value, so a job needs no installed package there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
