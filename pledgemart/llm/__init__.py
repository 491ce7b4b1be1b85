"""Operators for preparing training text. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

from pledgemart.operators import staging

# Python workers get the functions of this package, and those it stages with, by value, so they need no copy of it.
for module in (sys.modules[__name__], staging):
    cloudpickle.register_pickle_by_value(module)
