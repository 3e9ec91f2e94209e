"""Models: pure functions DataFrame... -> DataFrame; writers live in sources/sinks.py."""
