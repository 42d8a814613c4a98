"""Column expressions: no DataFrame, no shuffle, no Python at run time."""
