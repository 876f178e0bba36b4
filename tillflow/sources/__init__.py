"""Readers: CSV landings, stored tables, JDBC, and the star-schema adapter."""
