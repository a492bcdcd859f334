"""Query catalogue over the landed test tables and its SQL oracle."""
