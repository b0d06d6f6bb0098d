"""Queries over the supplied tables, the frames they run on and the SQL that checks them."""
