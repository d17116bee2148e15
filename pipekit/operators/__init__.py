"""DataFrame operators: joins, keys, quality, merge, history, change feeds, dimensions, audit."""
