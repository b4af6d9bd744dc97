"""Sources, sinks and schema conformance."""
