"""Sources: pushed-down scans, split planning, record inputs, a Python data source, and options."""
