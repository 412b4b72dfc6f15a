"""Writers of the three outputs."""
