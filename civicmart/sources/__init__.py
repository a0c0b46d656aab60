"""Sources and sinks: raw CSV and sheet-grid readers, driver-table bindings, the mart."""
