"""Inbox sources: fixture tables, CSV sweep, workbook cells, manifest."""
