"""Job order (``jobs``), the registered queries (``catalog``) and their SQL oracles (``oracle``)."""
