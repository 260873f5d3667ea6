"""Dataset-level analytics operators written as Spark jobs.

Every operator is a plain function from DataFrames and column names to a
DataFrame, so it composes with ``df.transform``.
"""

import sys

from pyspark import cloudpickle

# The few Python steps travel to the executors with the job, so the package
# does not have to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
