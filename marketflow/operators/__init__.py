"""DataFrame-to-DataFrame operators without input or output; usable on tables and streams."""
