"""Jobs over a log of run events."""
