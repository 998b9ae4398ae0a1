"""Per-grid-node statistics of point observations, on Spark."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the Python workers with the job, so executors need only pyspark,
# numpy, pandas and pyarrow and no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
