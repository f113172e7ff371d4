"""Reading and writing events and windows."""
