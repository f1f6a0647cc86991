"""The analyses: frames in, one lazy frame out; nothing is run, printed or written."""
