"""Operators for preparing text corpora. Nothing outside this subpackage imports it.

Functions that tasks run are sent with their code, so that executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
