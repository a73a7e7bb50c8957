"""Training-data operators: one module per operator, their registered queries in ``queries``.

Nothing outside this package imports it. What its operators run inside Spark tasks is
pickled by value, so an executor needs no copy of the repository on its path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
