"""Operators for preparing training text at scale. Nothing else in the library imports this subpackage.

Functions that run inside tasks are shipped by value, so executors need numpy, pyarrow and the tokenizer libraries, but no
copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
