"""Reading report files, landed JSON and small lookup files."""
