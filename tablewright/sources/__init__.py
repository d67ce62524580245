"""Sources and sinks: CSV, landed JSON pages and envelopes, HTML tables, catalog tables."""
