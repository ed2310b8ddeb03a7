"""Landing files and message buses, as batch or streaming DataFrames."""
