"""Training-data operators: dedup, quality, privacy, packing, mixing, scoring,
URL rules, nearest neighbours and licence scans, each at corpus scale.

Nothing else in the library imports this subpackage.  Its functions travel to
the executors by value, so workers need no installed copy of the library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
