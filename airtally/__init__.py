"""Live-broadcast and game analytics as plain PySpark DataFrame functions."""
