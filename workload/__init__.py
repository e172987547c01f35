"""The library's operators over the given tables, each with its SQL counterpart."""
