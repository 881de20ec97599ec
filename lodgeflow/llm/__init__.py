"""Operators of a training-data pipeline; nothing else in the library imports this subpackage.

Functions of this subpackage travel to the workers by value, so that a worker needs
numpy, pandas and pyarrow but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
