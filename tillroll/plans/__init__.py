"""Named query plans over the driver tables (the ``queries()`` catalogue)."""
