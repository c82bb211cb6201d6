"""Reading raw files, loading star tables, publishing results."""
