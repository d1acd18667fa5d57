"""Query plans over the supplied tables: stand-in adapters, the registered
query catalog and its SQL oracles."""
