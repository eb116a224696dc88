"""playlens: recommender analytics on interaction tables, written as Spark DataFrame / SQL / ML jobs.

Sub-packages
    sources    table readers, fixture derivations, file sinks
    functions  column-level helpers (hash ids, vector math, exact positions, bounded broadcast)
    operators  the analytics: statistics, down-sampling, metadata features, ranking metrics,
               recommenders (popularity, ALS, blocked top-k), cold-start regression
    plans      composed jobs and the registry of named queries with their SQL oracles
    streaming  incremental (file-stream) form of the interaction statistics
"""

import sys

from pyspark import cloudpickle

from playlens.session import build_session, ensure_checkpoint_dir

# Python workers need not have this package installed: functions that run in tasks (the pandas
# block scorers, the statistics passes) are shipped by value with each job, not by import path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["build_session", "ensure_checkpoint_dir"]
