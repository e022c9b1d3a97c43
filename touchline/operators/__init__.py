"""DataFrame-to-DataFrame operators over match rows."""
