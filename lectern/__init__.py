"""A PySpark engine for transcript corpora: clean, segment, summarise, export and annotate text at cluster scale."""

import sys

from pyspark import cloudpickle

#: Functions go to Python workers by value, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
