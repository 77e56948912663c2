"""The library's operators as queries over the test tables, each with its SQL oracle."""
