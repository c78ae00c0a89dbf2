"""Result sinks (parquet by task partition, or JDBC)."""

from visitlens.sinks.writers import clear_result, conform_result, read_result, write_jdbc, write_result

__all__ = ["clear_result", "conform_result", "read_result", "write_jdbc", "write_result"]
