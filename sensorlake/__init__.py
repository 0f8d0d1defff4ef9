"""sensorlake: Spark-native cleaning and analytics for keyed sensor-reading streams.

Every operator takes and returns DataFrames; row work runs on executors.
Sub-packages:

* ``sources``   - log envelope encode/decode, bounded and streaming reads, planted fixture
* ``functions`` - column expressions (parsing, time features, safe ratios)
* ``operators`` - dedup, imputation, dispositions, late arrivals, analytics, partitions, windows
* ``plans``     - composed batch plans (cleaning, reports, workflow) and the query registry
* ``streaming`` - Structured Streaming queries, foreachBatch sinks and progress metrics
"""

from sensorlake.session import get_session, scratch_dir  # noqa: F401

__version__ = "0.1.0"
