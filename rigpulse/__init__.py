"""Machine-fleet telemetry analytics: plain functions from DataFrame to DataFrame."""
