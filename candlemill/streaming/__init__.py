"""The batch event job over files as they land."""
