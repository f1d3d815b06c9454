"""Query plans over the driver tables: role mapping, queries and their SQL oracles."""
