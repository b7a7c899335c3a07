"""Operators that prepare text corpora for training.

Functions of this package that run in Python workers are shipped with the job,
so the workers need no installed copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
