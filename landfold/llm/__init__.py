"""Operators for preparing training text. Nothing else in the library imports this subpackage.

Functions that run in tasks are sent with the job, so executors need no copy of the library.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
