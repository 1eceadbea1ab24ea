"""Operators of a training-data pipeline: filters, deduplication, scans, mixing.

Tasks get the functions of this subpackage by value, so that workers need no
copy of it on their own import path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
