"""Writers: files with descriptors, tables, documents, sitemaps."""
