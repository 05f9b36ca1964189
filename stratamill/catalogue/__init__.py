"""The queries this library answers on the driver tables, with their SQL counterparts."""
