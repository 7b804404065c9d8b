"""Files in, tables out."""
