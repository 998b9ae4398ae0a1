"""Tables, files, footers and catalogs."""
