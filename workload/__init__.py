"""The engine on the given tables: bindings, registered queries, their SQL."""
