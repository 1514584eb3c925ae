"""Part of linkmill."""
