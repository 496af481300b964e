"""Writers: reports, staged and published tables, exchange file."""
