"""riverbend: batch and Structured Streaming analytics operators on Spark."""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel with their code: workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
