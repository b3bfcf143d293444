"""Writing tables, reports and exports."""
