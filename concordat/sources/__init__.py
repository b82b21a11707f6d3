"""Tables, catalogs, files and publishing."""
