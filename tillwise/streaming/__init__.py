"""Live alerts and minute metrics; every step also runs on a static DataFrame."""
