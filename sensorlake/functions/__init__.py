"""Column-level functions: pure expressions, kept inside whole-stage codegen."""

from sensorlake.functions.features import add_time_features, legacy_types  # noqa: F401
from sensorlake.functions.parse import parse_readings, with_event_time  # noqa: F401
from sensorlake.functions.scalar import safe_rate, seconds_between, to_ntz  # noqa: F401
