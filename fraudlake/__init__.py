"""fraudlake: transaction-fraud lakehouse analytics on Spark.

functions/  column expressions (quality rules, contracts, features, alias)
sources/    readers and the fixture views over the driver's tables
operators/  batch operators (Silver, Gold, fan-in, erasure, split,
            evaluation, scoring, monitoring, model)
plans/      plan helpers, the medallion chain, registered queries, oracles
streaming/  Structured Streaming jobs (Bronze fork, keyed fan-in state, scorer)
sinks/      every writer
"""

__version__ = "0.1.0"

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# functions that run on executors travel with the job: executors need not have
# the package on their path
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
