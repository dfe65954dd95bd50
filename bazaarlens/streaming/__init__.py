"""Loads that go on: file streams of drops, tables that are rewritten only where a drop touches them."""
