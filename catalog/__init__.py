"""Registered queries and their check SQL, one module per operator family."""
