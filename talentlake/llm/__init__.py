"""Training-data operators: token counts, deduplication, decontamination,
scoring, mixing, quality and URL rules, chat formatting.

Nothing else in the library imports this subpackage. Its functions travel to
the executors by value, so that executors need no copy of the repository on
their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
