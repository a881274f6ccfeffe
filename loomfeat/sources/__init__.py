"""Sources and sinks and the mapping of the driver's tables onto the reference's roles."""
