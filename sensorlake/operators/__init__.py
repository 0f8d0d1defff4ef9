"""Relational operators over readings (all DataFrame in, DataFrame out)."""

from sensorlake.operators.analytics import (  # noqa: F401
    active_sensors,
    correlation_matrix,
    sensor_stats,
    status_distribution,
    summary_stats,
)
from sensorlake.operators.impute import trailing_mean  # noqa: F401
from sensorlake.operators.partitions import counts, delivery_check, reader_load, skew  # noqa: F401
from sensorlake.operators.prefix import exclusive_prefix, inclusive_prefix  # noqa: F401
from sensorlake.operators.quality import dedup_first, first_flags, gate, late_arrivals, outcome_sql  # noqa: F401
from sensorlake.operators.quantile import exact_median  # noqa: F401
from sensorlake.operators.windows import (  # noqa: F401
    dedup_watermark,
    eligible,
    tumbling_avg,
    watermarked,
    window_avg_batch,
)
