"""Operations of a training-data pipeline. Nothing else in the library imports this folder."""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel with the job: no copy of the package is needed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
