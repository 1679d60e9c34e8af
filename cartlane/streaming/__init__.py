"""The change feed: decoding, current state, status history, fan-out by table."""
