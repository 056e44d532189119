"""Sources and sinks: raw role tables, feature-snapshot store, reports."""
