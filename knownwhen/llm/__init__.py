"""Operators of a training-data pipeline. Nothing else in the library imports this package.

Functions that run inside Python workers, and what they use of the library, travel with the
job, so that executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__.partition(".")[0]])
