"""Control rows, audit events and low-bound resolution."""
