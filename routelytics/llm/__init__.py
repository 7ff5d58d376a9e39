"""Training-data operators: ten corpus operators, one module each.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
``routelytics.llm.queries`` holds the registered queries.

Functions of this subpackage travel to the executors by value, so a cluster
needs no installed copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
