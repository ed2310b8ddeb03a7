"""Files, tables and messages out."""
