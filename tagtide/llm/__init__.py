"""Operators that prepare text for language-model training.

Nothing else in the library imports this subpackage. Its functions are sent to the
workers by value, so a job runs where the package is not installed on the executors.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
