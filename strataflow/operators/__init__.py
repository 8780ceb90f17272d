"""Set-at-a-time table operators: pure DataFrame to DataFrame functions."""
