"""The star-schema test tables seen as a catalogue, with query keys and their SQL."""
