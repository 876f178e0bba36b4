"""User-level operations composed from sources, operators and sinks."""
