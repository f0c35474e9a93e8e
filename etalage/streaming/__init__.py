

import sys

from pyspark import cloudpickle

# What runs in Python workers travels whole, so that executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
