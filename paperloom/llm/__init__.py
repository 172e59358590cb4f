"""Operators for preparing training data at corpus scale."""

import sys

from pyspark import cloudpickle

# Sent with each function, so that executors need no installed copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
