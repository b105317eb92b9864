"""Operators that prepare training data for language models."""

import sys

from pyspark import cloudpickle

# Functions sent to executors carry their code along, so that executors need the
# libraries but not this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
