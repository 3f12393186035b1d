"""Named queries over the test tables, with the same in SQL."""
