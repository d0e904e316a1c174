"""The jobs a user runs, built from sources, operators and sinks."""
