"""Operations of a training-data pipeline: sharding, near-duplicates, filters, archives, search, packing."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with them; executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
