"""End-to-end plans (publish, validate, report) and the registered table queries."""
