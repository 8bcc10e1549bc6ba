"""Column functions: no shuffle, no Python at run time."""
