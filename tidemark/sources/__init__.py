"""Sources, sinks and the lake."""
