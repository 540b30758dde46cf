"""Operators for preparing training data: archives, mixing, filters, duplicates, packing, search.

Their task functions travel to the executors with the job, so that nothing has to be installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
