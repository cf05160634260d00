"""Operators of a training-data pipeline: one module each, and their registered queries."""

import sys

from pyspark import cloudpickle

# Functions run on executors travel with their code, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
