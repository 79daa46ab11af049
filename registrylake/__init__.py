"""Registry lakehouse: zipped public company files to silver and gold Spark tables."""

import sys

from pyspark import cloudpickle

# Ship the code of all modules with the tasks, so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
