"""The folder-level encode as an incremental job."""
