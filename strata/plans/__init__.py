"""End-to-end jobs and the driver testbed registry."""
