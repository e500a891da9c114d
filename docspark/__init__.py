"""docspark: a PySpark engine for document corpora.

Every public operator is ``f(df, ..., **params) -> DataFrame``: Spark expressions,
joins, aggregates and windows, no driver loops and no global session.

Sub-packages:
  sources    -- intake, path parsing, page files, corpus adapters over plain tables
  functions  -- reusable Column expressions (text rules, hashing, vectors)
  operators  -- page extraction, summarisation, reports, index, rendering,
                chunking/embedding, retrieval, analytics
  plans      -- end-to-end compositions and the registered query catalogue
  streaming  -- file-stream intake, idempotent index upserts, progress
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions that run in tasks travel by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
