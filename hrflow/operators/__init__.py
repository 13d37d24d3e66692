"""DataFrame -> DataFrame operators; I/O lives in ``sources`` and ``sinks``."""
