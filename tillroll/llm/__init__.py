"""Training-data operators.  Nothing else in the library imports this subpackage.

Functions of this subpackage that run in Python workers are sent there by value, so executors need
the public libraries but not this package."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
