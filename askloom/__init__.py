"""askloom: document retrieval, question answering and evaluation as Spark jobs.

Every operator takes and returns DataFrames.  The only Python that runs on rows is
the recursive splitter, the default embedder, the similarity kernel, the binary file
parsers and the user's own hooks; Spark partitions and shuffles the work for all of them.
"""

import sys

from pyspark import cloudpickle

# Workers receive the code of the hooks and Arrow functions with the task, so the
# package does not have to be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
