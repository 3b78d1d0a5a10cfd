"""shoplens.streaming."""
