"""Sources and sinks: declared schemas, table loading, CSV edge, prediction store, fixture adapters."""
