"""Reading and writing of trip tables, zone files, messages and reports."""
