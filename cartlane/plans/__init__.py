"""Plan shapes that stay whole and even when one key holds a large share of the rows."""
