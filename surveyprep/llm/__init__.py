"""Training-data operators (packing, deduplication, search, mixing, filters, archives).

Nothing else in the library imports this subpackage. Each module holds one
operator with a general interface; ``registry`` holds the thin queries.
"""

import sys

from pyspark import cloudpickle

# tasks get this subpackage's code with the job, so executors need no copy of the repository
cloudpickle.register_pickle_by_value(sys.modules[__name__])
