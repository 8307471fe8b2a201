"""Tables and event logs: reading, writing, naming."""
