"""Registered queries over the shared tables and the SQL they are compared with."""
