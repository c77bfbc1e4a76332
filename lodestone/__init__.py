"""Vector retrieval and document ingestion as Spark jobs over tables."""

import sys

from pyspark import cloudpickle

# Ship this package inside task closures, so that executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
