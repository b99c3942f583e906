"""Growing folders of raw files, read in bounded pieces."""
