"""The incremental load as a file stream."""
