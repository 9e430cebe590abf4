"""DataFrame-to-DataFrame transforms; no module here does I/O."""
