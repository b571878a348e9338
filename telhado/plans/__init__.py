"""Composite jobs: collection planning and the bronze, silver and gold layers."""
