"""Sources and sinks: bronze payloads, board registry, silver tables."""
