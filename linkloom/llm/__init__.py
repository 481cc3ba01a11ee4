"""Operators for preparing training text.

Nothing else in the library imports this subpackage.  Its functions are
pickled by value, so executors need the installed third-party packages only,
not this library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
