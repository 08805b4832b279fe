"""Training-data operators: one module per operator, each built by one named
method, plus the thin registered queries (``queries.py``).

Nothing else in ``trawl`` imports this package. Functions that run inside
Spark tasks are shipped by value, so executors need no install of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
