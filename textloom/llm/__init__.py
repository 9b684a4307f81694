"""Operators for preparing training corpora.

Nothing else in the library imports this subpackage. Functions of it travel to Python workers by
value, so executors need no copy of the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
