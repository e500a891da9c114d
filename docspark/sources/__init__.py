"""Sources and sinks: intake requests, blob paths, page files, corpus adapters."""
