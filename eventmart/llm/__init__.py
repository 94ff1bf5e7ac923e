"""Training-data operators at corpus scale; nothing outside this subpackage imports it."""
