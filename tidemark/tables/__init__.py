"""Tables whose files in force are named by numbered commits."""
