"""DataFrame to DataFrame operators, and the sinks."""
