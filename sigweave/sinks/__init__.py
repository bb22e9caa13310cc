"""Message frames and sinks."""

from sigweave.sinks.messages import all_columns_message, key_partition, keyed_message
from sigweave.sinks.writers import fan_out, jdbc_options, write_sink

__all__ = [
    "all_columns_message",
    "fan_out",
    "jdbc_options",
    "key_partition",
    "keyed_message",
    "write_sink",
]
