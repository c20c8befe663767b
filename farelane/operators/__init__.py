"""DataFrame-to-DataFrame operators over trips."""
