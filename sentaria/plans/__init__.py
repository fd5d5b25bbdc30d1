"""Jobs, job sizing and the registered queries."""
