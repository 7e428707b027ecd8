"""Operators for preparing training text, one module each; ``queries`` registers them."""

import sys

from pyspark import cloudpickle

# Functions sent to executors carry their code, so that this folder need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
