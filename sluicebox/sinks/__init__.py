"""Writers for every output."""
