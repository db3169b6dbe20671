"""Registered queries: operators applied to the test tables, with the SQL that each is compared with."""
