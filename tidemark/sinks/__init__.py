"""Writers by logical name."""

from tidemark.sinks.write import output_type, replaces_partitions, write_output

__all__ = ["output_type", "replaces_partitions", "write_output"]
