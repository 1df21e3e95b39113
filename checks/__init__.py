"""Binding of the library to the generated tables: input views, registered queries, oracle SQL."""
