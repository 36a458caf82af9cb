"""Wiring of operators into whole jobs, and the registry behind the driver contract."""
