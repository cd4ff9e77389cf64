"""cartflow: shop event analytics as Spark DataFrame jobs.

Layout
------
- ``functions``  column expressions (time arithmetic, ratios, labels)
- ``sources``    schemas, raw CSV ETL, test-table adapters, sinks/exports
- ``operators``  sessionisation, marts, segments, features, ranks, models
- ``plans``      jobs that compose operators, the query registry and the
                 oracle SQL used by the correctness gate
- ``llm``        operators of a training-data pipeline

Every operator is ``DataFrame -> DataFrame`` and lazy; the only driver reads
are documented one-row results (counts, thresholds, metrics).
"""

from cartflow.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
