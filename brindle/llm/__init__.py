"""Operators for preparing language-model training data.

Nothing outside this subpackage imports it. Its functions are pickled by value, so executors
need not have the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
