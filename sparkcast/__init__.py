"""sparkcast: retail demand analytics as Spark DataFrame jobs.

Sub-packages
------------
sources    table readers/writers, the ``demand`` panel view, the feature store
functions  column expressions (calendar, safe arithmetic, moments)
operators  DataFrame -> DataFrame operators (cleaning, validation, ordered
           windows, features, profiling, metrics, drift, models)
plans      the named query catalogue used by ``__spark_entry__`` and the bench
streaming  row-local operators wired to Structured Streaming
"""

from sparkcast.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
