"""tabkit: tabular feature preparation, profiling, similarity, model training
and evaluation as Spark DataFrame operators.

Every operator is a function ``DataFrame -> DataFrame`` (fit functions return
small parameter objects holding fitted statistics only).  Sub-packages:

* ``tabkit.sources``   – readers, writers, incremental ingest, page explode
* ``tabkit.functions`` – column-expression helpers (hash buckets, null-safe
  correlation, skewness, prefix sums over an ordered key)
* ``tabkit.operators`` – the operator library (columns, missing, encode,
  scale, split, profile, similar, metrics, models)
* ``tabkit.plans``     – registered end-to-end queries over the driver tables
* ``tabkit.streaming`` – the Structured Streaming form of the ingest
"""

from tabkit.session import ensure_checkpoint_dir, get_session, prepare

__all__ = ["get_session", "ensure_checkpoint_dir", "prepare"]
