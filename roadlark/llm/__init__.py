"""Operators for preparing training data for language models; nothing else imports them.

Functions of these modules travel to the executors by value, so that a job does not
depend on the library being installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
