"""shoplens.sinks."""
