"""Training-data operators: token counts, near-duplicate detection, scans and filters.

Each module holds one operator (a function from DataFrames to a DataFrame)
with its own method; ``queries`` applies them to the driver tables.  Nothing
outside this package imports it.
"""

import sys

from pyspark import cloudpickle

# Tasks get these functions by value: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
