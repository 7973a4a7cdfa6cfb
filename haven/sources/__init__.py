"""Sources and sinks: fixtures, seed files, JDBC, stream sources, layouts."""
