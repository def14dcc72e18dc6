"""Sources and sinks: log CSVs, events view, CSV/metric sinks, model store."""
