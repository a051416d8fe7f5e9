"""Evidence-checked extraction analytics, expressed as Spark DataFrame plans."""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers carry their code along, so executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
