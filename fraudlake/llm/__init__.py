"""Training-data operators: quality resampling, packing, BPE, language ID, token
files, licence scans, near-duplicate joins, fingerprints, URL filters, vector search.

Nothing outside this folder imports it. Functions that run on executors are
pickled by value, so executors need not have the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
