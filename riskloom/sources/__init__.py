"""Sources and sinks: mart readers, the driver-table adapter, writers."""
