"""Sources and sinks (S-01..S-11) and the binding of the test tables."""
