"""Training-data operators on Spark DataFrames.

One module per operator (sharding, licence scan, quality rules, archive
conversion, chat assembly, mixing, nearest neighbours, byte-level BPE, MinHash
near-duplicates, additive quality model, language identification, conversation
repair, centroid clustering); ``queries`` binds them to the tables.
Nothing else in the library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# functions that run in tasks travel with their code, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
