"""Conversation-event analytics on PySpark."""
