"""Sources: tables and streams read as ticks, landed responses, TSV loads."""
