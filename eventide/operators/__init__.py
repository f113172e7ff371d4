"""DataFrame operators over events and windows."""
