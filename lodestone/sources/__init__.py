"""Source descriptions, scans, scoping, sync and web page processing."""
