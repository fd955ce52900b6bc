"""Operators for preparing language-model training text; nothing else in the library imports this."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors by value: they need no copy of it there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
