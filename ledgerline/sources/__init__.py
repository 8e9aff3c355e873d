"""Sources and sinks: raw files, driver views, warehouse tables, CSV exports."""
