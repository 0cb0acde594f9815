"""Reading exports and writing reports."""
