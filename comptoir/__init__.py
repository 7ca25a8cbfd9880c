"""comptoir: a retail lake (raw, processed, curated) expressed as Spark jobs."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with them, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
