"""Registered queries, their SQL counterparts and the test stars they read."""
