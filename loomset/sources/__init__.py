"""Reading and writing tables, and the few file-system checks the jobs need."""
