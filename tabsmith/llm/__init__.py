"""Operators of a text-corpus pipeline; nothing else in the library imports them.

The modules are pickled by value, so Python workers need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
