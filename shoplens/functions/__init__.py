"""shoplens.functions."""
