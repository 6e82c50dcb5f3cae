"""lettrine: a Spark-native engine for mail archives and document pipelines.

Stages are pure ``DataFrame -> DataFrame`` functions; side effects live in the
connectors of :mod:`lettrine.sources` and in the sinks of :mod:`lettrine.plans`.
"""

__version__ = "0.1.0"
