"""Operators that prepare text corpora for model training.

Functions that run inside Python tasks travel with the job, so executors need the third-party libraries only.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
