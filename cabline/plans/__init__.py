"""Jobs and query bindings."""
