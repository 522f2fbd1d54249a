"""Operators for training corpora: filtering, deduplication, mixing, packing, search.

Nothing else in the library imports this subpackage. Each operator takes DataFrames and returns DataFrames; the thin
queries ``opN_<name>`` over the given tables are in modules of their own, which ``queries.py`` gathers.
"""

import sys

from pyspark import cloudpickle

# Executors need not have this package installed: its functions travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__.partition(".")[0]])
