"""Sources and record adapters."""
