"""Operations of a training-data pipeline; nothing else in the library imports this subpackage.

Its functions run inside Python workers: they are sent by value, so that executors need no
installed package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
