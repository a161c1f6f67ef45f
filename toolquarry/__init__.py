"""Tool-calling training data on Spark.

Source files in, tool catalog out; catalog in, sample conversations out; samples
and catalog in, training text out.  Every operator takes and returns DataFrames.
"""

import sys

from pyspark import cloudpickle

# Helpers that run inside tasks travel with the job, so the executors need no
# installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
