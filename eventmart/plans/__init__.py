"""Jobs, reporting views and analyses."""
