"""Operators for preparing training data: packing, pseudonyms, de-duplication, selection and search.

Every operator takes and returns DataFrames. Texts are worked on in Arrow batches inside tasks;
grouping, joining and ranking are Spark's.
"""

import sys

from pyspark import cloudpickle

# Functions travel to the executors inside their tasks, so a cluster needs no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
