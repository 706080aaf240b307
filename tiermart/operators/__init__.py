"""DataFrame operators: latest rows, intervals, table changes and joins."""
