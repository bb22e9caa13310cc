"""Sources of lines and of dimension tables."""

from sigweave.sources.dimensions import read_dimension
from sigweave.sources.lines import kafka_options, read_lines
from sigweave.sources.versions import VersionedDimension

__all__ = ["VersionedDimension", "kafka_options", "read_dimension", "read_lines"]
