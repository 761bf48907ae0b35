"""Writers: search documents, keyed topic records, JSON lines, console."""
