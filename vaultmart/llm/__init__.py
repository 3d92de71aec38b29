"""Training-data operators: ten corpus operations over text tables.

Nothing else in the library imports this subpackage; the driver entry adds
its queries when it can be imported.
"""
