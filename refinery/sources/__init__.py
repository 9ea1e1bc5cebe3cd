"""Sources and sinks: landing files, versioned tables, partitioned Bronze tables."""
