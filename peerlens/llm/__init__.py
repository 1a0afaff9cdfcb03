"""Operators for training-data pipelines; nothing else in the library imports them.

The functions that run inside tasks are shipped to the workers by value, so
they need not have the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
