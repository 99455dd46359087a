"""Training-data operators: sharding, URL filters, license scans, near-duplicates,
packing, toxicity and mixing, each a Spark job over whole tables.

Nothing else in the library imports this subpackage; ``llm.queries`` registers
one thin query per operator.
"""

import sys

from pyspark import cloudpickle

# Functions sent to executors travel by value: workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
